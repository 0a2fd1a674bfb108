"""The engine as one object: snapshot to candidates, verification, consolidation and live opportunities (API1 to API4, S15, S16).

One session and one graph of DataFrames; what several steps read is written once in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.functions import events
from xmarket.functions.hashing import pair_id
from xmarket.functions.lexicon import Lexicon
from xmarket.operators import candidates, decisions, envelopes, keywords, matching, metrics, sync
from xmarket.session import written
from xmarket.streaming.books import Scanner

col = F.col


@dataclass
class Settings:
    """Limits of a verification run, and the tables that a user may replace."""

    lexicon: Lexicon = field(default_factory=Lexicon)
    max_rank: int = 2
    min_quality: str = "weak"
    budget_rows: int | None = None
    run_budget: float | None = None
    cost_per_row: float = 0.0


class Engine:
    def __init__(self, spark: SparkSession, settings: Settings | None = None):
        self.spark, self.settings = spark, settings or Settings()
        self.scanner: Scanner | None = None

    def health(self) -> dict[str, Any]:
        """API1."""
        return {"status": "ok", "spark": self.spark.version}

    def sync(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """The next snapshot; refused if it shrank too far."""
        sync.shrink_guard(old.count(), new.count())
        return sync.snapshot_diff(old, new)

    def index(self, rows: DataFrame) -> DataFrame:
        """One row per event with its keywords; rows: platform, event_id, title, category, sub_category, bet_title, ord."""
        from xmarket.sources.markets import event_index

        platform = rows.groupBy("event_id").agg(F.first("platform").alias("platform"))
        idx = event_index(rows.drop("platform")).join(platform, "event_id")
        return idx.withColumn("keywords", keywords.extract_keywords(col("title"), col("category"), col("sub_category"), self.settings.lexicon))

    def candidates(self, index: DataFrame) -> DataFrame:
        """Every pair with scores, ranks and the reason why it is pruned, empty if it is kept."""
        index = written(index, "index")
        pairs = written(candidates.build_pairs(index.drop("bet_titles", "bet_title_count"), self.settings.lexicon.categories), "pairs")
        profiles = written(events.profiles(index, self.settings.lexicon), "profiles")
        scored = candidates.semantic_features(pairs, profiles, candidates.keyword_statistics(index))
        return candidates.prune(scored, self.settings.max_rank)

    def exclusive(self, kept: DataFrame) -> DataFrame:
        """S8 over the order of candidates."""
        return candidates.greedy_exclusive(kept, candidates.candidate_order())

    def report(self, pruned: DataFrame) -> dict[str, Any]:
        """The run's counts: pairs before and after, reasons, and the largest component on both sides."""
        reasons = {r["prune_reason"] or "kept": r["n"] for r in pruned.groupBy("prune_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
        largest = lambda df: (candidates.component_statistics(df).limit(1).collect() or [None])[0]
        before, after = largest(pruned), largest(pruned.where("prune_reason = ''"))
        total = sum(reasons.values())
        shape = lambda r: {"edges": r["edges"], "nodes": r["nodes"]} if r else {"edges": 0, "nodes": 0}
        return {"pairs": total, "kept": reasons.get("kept", 0), "reasons": reasons, "reduction": 1 - reasons.get("kept", 0) / total if total else 0.0, "largest_before": shape(before), "largest_after": shape(after)}

    def todo(self, kept: DataFrame, matched: DataFrame) -> DataFrame:
        """Candidates without matched ends, of enough quality, most urgent first, within the budget of rows."""
        open_pairs = sync.without_ids(kept, matched, ("k_id", "k_id"), ("p_id", "p_id"))
        open_pairs = open_pairs.where(metrics.meets_quality(col("quality_tier"), self.settings.min_quality))
        points = metrics.priority(col("quality_score"), col("quality_tier"), col("n"), col("jac"), F.lit(0))
        named = open_pairs.withColumn("priority", points).withColumn("pair_id", pair_id(F.lit("event"), col("k_id").cast("string"), col("p_id").cast("string")))
        return named if self.settings.budget_rows is None else named.orderBy(F.desc("priority"), "pair_id").limit(self.settings.budget_rows)

    def verify(self, todo: DataFrame, cache: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
        """API4, S3: decoded decisions of the pairs that the cache lacks; the scorer is any function on Arrow batches."""
        payload = todo.select("pair_id", "k_id", "p_id", "quality_score")
        answers = decisions.verify_missing(payload, cache, ["pair_id"], scorer, self.settings.run_budget, self.settings.cost_per_row)
        answers = written(answers.withColumn("batch_id", col("pair_id")), "answers")
        return decisions.decode(answers, answers.select("pair_id", "batch_id")).join(payload, "pair_id")

    def consolidate(self, records: DataFrame) -> DataFrame:
        """The one-to-one mapping of highest total weight among valid matches."""
        weight = matching.decision_weight(col("confidence"), col("quality_score"), F.lit(0), F.lit("cheap"))
        return matching.maximum_weight_matching(records.where("status = 'valid' and decision = 'MATCH'").withColumn("weight", weight))

    def refresh(self, rows: DataFrame, matched: DataFrame, cache: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series], apply: bool = True) -> dict[str, Any]:
        """API2: index, candidates, verification and consolidation in one job; a dry run stops before the scorer."""
        pruned = written(self.candidates(self.index(rows)), "candidates")
        out: dict[str, Any] = {"report": self.report(pruned)}
        todo = self.todo(pruned.where("prune_reason = ''"), matched)
        out["todo"] = todo
        if apply:
            out["decisions"] = written(self.verify(todo, cache, scorer), "decisions")
            out["matches"] = self.consolidate(out["decisions"])
        return out

    def contracts(self, pairs: DataFrame, done: DataFrame) -> DataFrame:
        """Contract pairs of matched events that aren't done, one to one, none with a hard conflict."""
        from xmarket.functions.contracts import hard_conflict

        todo = pairs.join(done.select("k_bet_id", "p_bet_id"), ["k_bet_id", "p_bet_id"], "left_anti")
        side = lambda s: {name: col(f"{s}_{name}") for name in ("days", "percent", "deadline")}
        return envelopes.one_to_one(todo, hard_conflict(side("k"), side("p")), [F.desc("score"), F.asc("k_bet_id"), F.asc("p_bet_id")])

    def start(self, messages: DataFrame, mapping: DataFrame, checkpoint: str, sink: str, **options: Any) -> None:
        """API1, ST6."""
        if self.scanner is not None and self.scanner.status()["running"]:
            raise RuntimeError("the scanner runs already")
        self.scanner = Scanner(messages, mapping, checkpoint, sink).start(**options)

    def stop(self) -> None:
        if self.scanner is not None:
            self.scanner.stop()

    def status(self) -> dict[str, Any]:
        return self.scanner.status() if self.scanner is not None else {"running": False, "progress": None}

    def opportunities(self, min_profit: float = 0.0, min_roi: float = 0.0) -> DataFrame:
        """API1, F9."""
        if self.scanner is None:
            raise RuntimeError("the scanner was never started")
        return self.scanner.current().where((col("profit") >= min_profit) & (col("roi") >= min_roi))
