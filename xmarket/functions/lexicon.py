"""Word lists and patterns of the matching rules.

Everything here is fixed: results depend on these very values.  Larger tables (abbreviations, category
mappings, outcome intents) are parameters, read by Lexicon.from_folder().
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

# Words that carry no meaning in titles and keywords.
STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any", "are", "as", "at", "be", "been", "before",
    "being", "below", "between", "but", "by", "can", "could", "did", "do", "does", "doing", "during", "each", "few", "for", "from",
    "further", "had", "has", "have", "having", "he", "her", "here", "hers", "him", "his", "how", "i", "if", "in", "into", "is", "it",
    "its", "me", "more", "most", "my", "no", "nor", "not", "of", "off", "on", "once", "only", "or", "our", "ours", "out", "over",
    "own", "same", "she", "should", "so", "some", "such", "than", "that", "the", "their", "theirs", "them", "then", "there", "these",
    "they", "this", "those", "through", "to", "under", "until", "up", "was", "we", "were", "what", "when", "where", "which", "while",
    "who", "whom", "why", "will", "with", "would", "you", "your",
]
GENERIC_MARKET_WORDS = [
    "achieve", "achieved", "announce", "announced", "around", "begin", "best", "become", "called", "call", "change", "close", "come",
    "day", "days", "end", "event", "finish", "first", "game", "get", "gets", "go", "going", "good", "got", "happen", "happens",
    "high", "hit", "hold", "keep", "last", "launch", "leave", "less", "lifetime", "live", "low", "made", "make", "market", "markets",
    "more", "move", "name", "named", "new", "next", "old", "open", "out", "pass", "play", "price", "reach", "release", "released",
    "result", "run", "score", "set", "start", "starts", "take", "takes", "time", "today", "tomorrow", "total", "visit", "vs", "vs.",
    "week", "win", "winner", "wins", "won", "work", "x", "yes",
]
TITLE_STOP_WORDS = [
    "a", "an", "and", "any", "are", "at", "be", "before", "by", "does", "end", "for", "from", "have", "has", "how", "if", "in", "is",
    "many", "much", "next", "of", "on", "or", "the", "this", "to", "what", "when", "where", "which", "who", "will", "with",
]
GENERIC_SINGLE_KEYWORDS = [
    "announced", "arrested", "attend", "before", "confirmed", "countries", "country", "election", "file", "files", "game", "law",
    "market", "house", "order", "orders", "president", "presidential", "price", "primary", "seat", "seats", "season", "senate",
    "winner", "year",
]
GENERIC_ENTITY_TERMS = [
    "baseball", "basketball", "champion", "cup", "democratic", "election", "fifa", "football", "governor", "group", "league",
    "match", "nominee", "party", "president", "pro", "republican", "season", "tournament", "world",
]
PARTICIPANT_NOISE = ["ac", "afc", "as", "ca", "cf", "club", "de", "fc", "hc", "ogc", "rb", "rc", "rcd", "sc", "w"]

# Spellings of one keyword.
ALIASES = {
    "aoc": "alexandria ocasio cortez", "barca": "fc barcelona", "barcelona": "fc barcelona", "basis point": "basis points",
    "basis points": "basis points", "biden": "joe biden", "bps": "basis points", "brazilian": "brazil", "btc": "bitcoin",
    "costa rican": "costa rica", "cpi": "consumer price index", "djt": "donald trump", "donald j trump": "donald trump",
    "donald j. trump": "donald trump", "dow": "dow jones", "eth": "ethereum", "fed": "federal reserve",
    "fomc": "federal open market committee", "gdp": "gross domestic product", "gpt6": "gpt-6", "gpt 6": "gpt-6",
    "harris": "kamala harris", "ipo": "initial public offering", "musk": "elon musk", "nasdaq": "nasdaq", "open ai": "openai",
    "paris saint germain": "paris saint-germain", "paris sg": "paris saint-germain", "pce": "personal consumption expenditures",
    "ppi": "producer price index", "psg": "paris saint-germain", "rfk": "robert f kennedy", "s&p": "s&p 500", "s&p500": "s&p 500",
    "sp500": "s&p 500", "tesla motors": "tesla", "trump": "donald trump", "uk": "united kingdom", "u.k.": "united kingdom",
    "us": "united states", "u.s.": "united states", "usa": "united states", "u.s.a.": "united states", "xi": "xi jinping",
}
DOMAIN_WORDS = {
    "gpe": [
    "california", "brazil", "brazilian", "china", "costa rica", "costa rican", "france", "germany", "india", "iran", "israel",
    "japan", "new york", "russia", "texas", "ukraine", "united kingdom", "united states",
],
    "loc": ["earth", "mars", "moon"],
    "org": ["anthropic", "bitcoin", "ethereum", "federal reserve", "google", "microsoft", "nasdaq", "openai", "s&p 500", "tesla"],
    "person": ["alexandria ocasio cortez", "donald trump", "elon musk", "joe biden", "kamala harris", "robert f kennedy", "xi jinping"],
    "topic": ["basis points", "consumer price index", "gross domestic product", "inflation", "interest rates", "initial public offering", "tariffs"],
}

# What a title's event, market layer, action, stage and direction are told by.
LAYERS = {
    "exact_score": r"\bexact score\b",
    "first_half": r"\b(?:half[ -]?time|first half|1st half)\b",
    "map": r"\bmap\s*\d*\b",
    "more_markets": r"\bmore markets\b",
    "spread": r"\b(?:spread|wins? by|margin of victory)\b",
    "total": r"\b(?:total|over/under|o/u)\b",
}
SCOPES = {
    "aggregate": r"\b(?:which party|control of|majority in|majority of|balance of power)\b",
    "annual_end": r"\b(?:at the end of|by the end of|year[ -]?end)\b",
    "annual_window": r"\b(?:in|during)\s+20[2-3][0-9]\b",
    "award": r"\b(?:mvp|most valuable player|golden boot|top scorer|rookie of the year|player of the year)\b",
    "district": r"\b(?:district|[a-z]{2}-(?:\d{1,2}|al))\b",
    "general_election": r"\bgeneral election\b",
    "match": r"\b(?:match|fixture|game)\b|\b(?:vs\.?|v\.?)\b",
    "meeting": r"\bmeeting\b|\b(?:fed|fomc) decision in\b",
    "metric": r"\b(?:home ?runs?|strikeouts?|no hitter|perfect game|steals?|rbi|ops|doubles?|hits? leader|goals? leader|points? leader)\b",
    "primary": r"\b(?:primary|nominee|nomination)\b",
    "runoff": r"\b(?:runoff|second round)\b",
    "seat": r"\b(?:house|senate|mayoral|governor) race for\b",
    "season": r"\bseason\b",
    "tournament": r"\b(?:tournament|championship|champion|cup|open|world series|classic)\b",
    "women": r"\b(?:women|woman|women's|womens|female)\b|\(w\)",
}
ACTIONS = {
    "approval": r"\b(?:approval|rating)\b",
    "qualify": r"\bqualif(?:y|ier|ies|ied)\b",
    "release": r"\b(?:release|released)\b",
    "retire": r"\b(?:retire|retirement)\b",
    "win": r"\b(?:win|wins|winner|champion)\b",
}
STAGES = {
    "final": r"\bfinals?\b",
    "group_stage": r"\bgroup stage\b",
    "quarterfinal": r"\bquarter[ -]?finals?\b",
    "round_of_16": r"\bround of 16\b",
    "round_of_32": r"\bround of 32\b",
    "semifinal": r"\bsemi[ -]?finals?\b",
}
DIRECTIONS = {
    "down": r"\b(?:at most|below|decrease|drop|fall|fewer than|less than|lower|lowest|under)\b",
    "exact": r"\b(?:exactly|equal to)\b",
    "up": r"\b(?:above|at least|exceed|greater than|higher|highest|more than|over)\b",
}
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
EXCLUSIVE_SCOPES = (
    ("primary", "general_election"), ("match", "season"), ("match", "tournament"), ("district", "aggregate"), ("seat", "aggregate"),
    ("group", "overall"), ("award", "overall"), ("award", "metric"), ("award", "match"), ("award", "season"),
    ("meeting", "annual_end"), ("meeting", "annual_window"),
)

# Terms of the rules that reject pairs by their titles.
TITLE_SCOPES = {
    "president": ["president", "presidential"],
    "senate": ["senate", "senator"],
    "house": ["house", "congressional district"],
    "governor": ["governor", "gubernatorial", "governorship"],
    "primary": ["primary", "nominee", "nomination"],
    "general": ["general election"],
    "approval": ["approval", "rating"],
    "winner": ["winner", "win", "champion"],
    "qualifier": ["qualifier", "qualify", "qualifies"],
    "margin": ["margin", "margin of victory"],
    "outright": ["outright", "first round"],
    "place": ["1st place", "2nd place", "3rd place", "place"],
    "artist": ["artist"],
    "album": ["album"],
    "song": ["song", "track"],
    "driver": ["driver", "drivers"],
    "constructor": ["constructor", "constructors"],
    "relegation": ["relegation", "relegated"],
}
OFFICES = ("president", "senate", "house", "governor")
EXCLUSIVE_TITLE_SCOPES = (("artist", "album", "song"), ("driver", "constructor"), ("winner", "qualifier", "relegation", "top_finish"))
UP_TERMS = ["above", "at least", "exceed", "exceeds", "greater than", "high", "higher", "highest", "increase", "over", "rise", "up"]
DOWN_TERMS = ["at most", "below", "decrease", "drop", "fall", "fewer than", "less than", "low", "lower", "lowest", "under", "down"]
THRESHOLD_TERMS = [
    "above", "approval", "at least", "at most", "below", "bps", "close", "fewer than", "greater than", "high", "higher", "low",
    "lower", "magnitude", "more than", "over", "percent", "price", "range", "score", "than", "under",
]
RELATION_TERMS = ["deal", "normalize", "relations", "sanction", "tariff", "treaty", "war"]
STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california", "co": "colorado", "ct": "connecticut",
    "de": "delaware", "fl": "florida", "ga": "georgia", "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana",
    "ia": "iowa", "ks": "kansas", "ky": "kentucky", "la": "louisiana", "me": "maine", "md": "maryland", "ma": "massachusetts",
    "mi": "michigan", "mn": "minnesota", "ms": "mississippi", "mo": "missouri", "mt": "montana", "ne": "nebraska", "nv": "nevada",
    "nh": "new hampshire", "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina", "nd": "north dakota",
    "oh": "ohio", "ok": "oklahoma", "or": "oregon", "pa": "pennsylvania", "ri": "rhode island", "sc": "south carolina",
    "sd": "south dakota", "tn": "tennessee", "tx": "texas", "ut": "utah", "vt": "vermont", "va": "virginia", "wa": "washington",
    "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming",
}
COUNTRIES = {
    "america": "united states", "argentina": "argentina", "argentine": "argentina", "argentinian": "argentina", "australia": "australia",
    "australian": "australia", "brazil": "brazil", "brazilian": "brazil", "britain": "united kingdom", "bulgaria": "bulgaria",
    "bulgarian": "bulgaria", "canada": "canada", "canadian": "canada", "china": "china", "chinese": "china", "colombia": "colombia",
    "colombian": "colombia", "czechia": "czechia", "denmark": "denmark", "danish": "denmark", "england": "england", "france": "france",
    "french": "france", "germany": "germany", "german": "germany", "great britain": "united kingdom", "india": "india", "indian": "india",
    "iran": "iran", "iraq": "iraq", "ireland": "ireland", "irish": "ireland", "israel": "israel", "italy": "italy", "italian": "italy",
    "japan": "japan", "mexico": "mexico", "mexican": "mexico", "nepal": "nepal", "palestine": "palestine", "peru": "peru",
    "peruvian": "peru", "poland": "poland", "polish": "poland", "romania": "romania", "romanian": "romania", "russia": "russia",
    "russian": "russia", "saudi arabia": "saudi arabia", "spain": "spain", "spanish": "spain", "slovenia": "slovenia",
    "slovenian": "slovenia", "syria": "syria", "ukraine": "ukraine", "ukrainian": "ukraine", "united kingdom": "united kingdom",
    "united states": "united states", "usa": "united states", "wales": "wales",
}
SPORTS = {
    "baseball": "baseball,mlb,wbc,world baseball classic,world series",
    "basketball": "basketball,nba,ncaa basketball,ncaa cbb,cbb,college basketball",
    "boxing": "boxing", "chess": "chess", "cricket": "cricket,ipl", "darts": "darts",
    "esports": "esports,video games,valorant,league of legends,counter-strike,cs2,dota",
    "football": "football,nfl,ncaa football,cfb,super bowl", "golf": "golf,pga,pga tour,the masters", "hockey": "hockey,nhl,khl,stanley cup",
    "lacrosse": "lacrosse", "mma": "mma,ufc", "motorsport": "motorsport,formula 1,f1,nascar,indycar", "rugby": "rugby,rugby union,rugby league",
    "soccer": "soccer,fifa,fifa world cup,epl,mls,uefa,champions league", "tennis": "tennis,atp,wta,roland garros,wimbledon",
}

# Categories.
MISSING_LITERALS = ("", "nan", "none", "null", "na", "n/a", "<na>")
BROAD_CATEGORIES = (
    "approval", "climate & science", "crypto", "crypto prices", "culture", "economics", "equities", "esports", "health", "mentions",
    "other", "politics", "science", "social", "sports", "up or down", "world", "world affairs",
)
CATEGORY_ALIASES = {
    "basketball": "nba|ncaa basketball|ncaa cbb|cbb", "baseball": "mlb|wbc|world baseball classic", "big tech": "tech|business",
    "bitcoin": "btc|crypto prices|hit price", "btc": "bitcoin|crypto prices|hit price", "business": "economics|economy",
    "charts": "music charts|billboard|hot 100", "congress": "house|house elections|house of representatives",
    "crypto prices": "crypto|bitcoin|btc|hit price", "doge": "dogecoin", "dogecoin": "doge", "economic policy": "economics|economy",
    "economics": "economy|economic policy|business|macro indicators", "economy": "economics|economic policy|business",
    "election": "elections", "elections": "election", "fed": "fed rates|economic policy|economics|economy",
    "fed rates": "fed|economic policy|economics|economy", "foreign elections": "global elections|world elections|elections",
    "foreign policy": "geopolitics|international|world|world affairs", "football": "nfl|ncaa football|cfb", "f1": "formula 1|motorsport",
    "formula 1": "f1|motorsport", "gdp": "growth|macro indicators|economics", "geopolitics": "foreign policy|international|world|world affairs",
    "global elections": "foreign elections|world elections|elections", "governor": "governorship|gubernatorial",
    "governor primary": "governor|primaries|primary elections", "growth": "gdp|macro indicators|economics",
    "hot 100": "billboard|charts|music charts", "house": "congress|house elections|house of representatives",
    "house elections": "house|congress|elections", "house of representatives": "house|congress",
    "international": "foreign policy|geopolitics|world|world affairs|global elections|world elections",
    "macro indicators": "economics|gdp|growth", "middle east": "foreign policy|geopolitics|international|world",
    "mlb": "baseball|wbc|world baseball classic", "midterms": "elections|us election|us elections|nov 4 elections",
    "music": "music charts|charts|billboard|hot 100|celebrities", "music charts": "music|charts|billboard|hot 100",
    "motorsport": "f1|formula 1|nascar|indycar", "nasdaq": "stocks|equities|nasdaq 100", "nba": "basketball",
    "ncaa basketball": "basketball|ncaa cbb|cbb", "nfl": "football|ncaa football|cfb", "nhl": "hockey",
    "nov 4 elections": "elections|us election|us elections|midterms", "primary": "primaries|primary elections",
    "primary elections": "primary|primaries", "primaries": "primary|primary elections",
    "republican primary": "republican party|primaries|primary elections", "democratic primary": "democratic party|primaries|primary elections",
    "senate": "senator", "senate primary": "senate|primaries|primary elections", "soccer": "world cup",
    "snow and rain": "weather|climate & weather", "sol": "solana", "solana": "sol", "tech": "big tech|business",
    "us election": "us elections|elections|midterms|nov 4 elections", "us elections": "us election|elections|midterms|nov 4 elections",
    "world elections": "foreign elections|global elections|elections", "ufc": "mma", "wbc": "baseball|world baseball classic",
    "world baseball classic": "baseball|wbc",
}
COMPATIBLE_CATEGORIES = (
    ("politics", "world", "world affairs", "nov 4 elections", "primaries"),
    ("science", "climate & science"),
    ("culture", "celebrities"),
    ("economics", "equities", "crypto", "crypto prices"),
)


def phrase(value: str) -> str:
    """The spelling under which a phrase is looked up (the same rule as functions.text.keyword_phrase)."""
    text = value.lower().strip().replace("’", "'").replace("`", "'")
    text = re.sub(r"'s\b", "", text).replace("_", " ").replace("&", " and ")
    return re.sub(r"\s+", " ", text).strip(" \t\r\n.,!?;:\"()[]{}")


def compact(value: str) -> str:
    return re.sub(r"[^a-z0-9:%$+-]+", "", phrase(value))


@dataclass
class Lexicon:
    """Tables that a user may replace; the defaults are the values above."""

    stop_words: list[str] = field(default_factory=lambda: list(STOP_WORDS))
    generic_words: list[str] = field(default_factory=lambda: list(GENERIC_MARKET_WORDS))
    aliases: dict[str, str] = field(default_factory=lambda: dict(ALIASES))
    domain_words: dict[str, list[str]] = field(default_factory=lambda: dict(DOMAIN_WORDS))
    categories: dict[str, list[str]] = field(default_factory=dict)
    abbreviations: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_folder(cls, folder: str) -> Lexicon:
        """Read <name>.json for each table that is there; others keep their defaults."""
        out = cls()
        for name, default in vars(out).items():
            path = Path(folder) / f"{name}.json"
            if path.exists():
                loaded = json.loads(path.read_text())
                setattr(out, name, type(default)(loaded))
        return out

    def alias_map(self) -> dict[str, str]:
        """Every spelling, exact and compact, to its canonical phrase."""
        out: dict[str, str] = {}
        for variant, canonical in self.aliases.items():
            v, c = phrase(variant), phrase(canonical)
            if v and c:
                out[v] = c
                if compact(v) and compact(v) != v:
                    out[compact(v)] = c
        return out

    def noise(self) -> list[str]:
        return sorted({phrase(w) for w in [*self.stop_words, *self.generic_words] if phrase(w)})

    def domain_tokens(self) -> dict[str, str]:
        """Phrase to LABEL:canonical."""
        aliases, out = self.alias_map(), {}
        for group, words in self.domain_words.items():
            for word in words:
                key = phrase(word)
                canonical = aliases.get(key) or aliases.get(compact(key)) or key
                out[key] = out[canonical] = f"{group.upper()}:{canonical}"
        return out
