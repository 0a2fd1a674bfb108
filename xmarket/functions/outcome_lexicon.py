"""Patterns that tell what an outcome's market asks for.

Everything here is fixed: results depend on these very values.
"""

from __future__ import annotations

# Outcome subjects that name nobody, and words of scopes and markets.
GENERIC_SUBJECTS = [
    "yes", "no", "other", "others", "none", "n/a", "na", "unknown", "above", "below", "before", "after", "over", "under", "any",
    "someone", "anyone", "a human", "human",
]
STOP_WORDS = [
    "a", "an", "and", "any", "are", "at", "be", "by", "does", "for", "from", "if", "in", "is", "of", "on", "or", "the", "this", "to",
    "will", "who", "which", "what", "when", "where", "with",
]
GENERIC_TOKENS = [
    "after", "announce", "announced", "award", "before", "best", "champion", "companies", "company", "countries", "country",
    "during", "election", "event", "events", "how", "leader", "many", "market", "most", "new", "next", "nominee", "officially",
    "party", "primary", "race", "regular", "season", "state", "states", "title", "top", "trophy", "what", "which", "who", "win",
    "winner", "winning", "wins", "year", "years",
]
SCOPE_WORDS = [
    "champion", "championship", "cup", "division", "election", "final", "governor", "group", "house", "mayor", "nominee", "playoff",
    "president", "presidential", "primary", "qualifier", "qualify", "round", "semifinal", "senate", "senator", "seat", "seats",
    "tournament", "winner", "world",
]
PHRASES = {
    "world cup": r"world cup", "world baseball classic": r"world baseball classic|\bwbc\b", "golden boot": r"golden boot", "super bowl": r"super bowl",
    "stanley cup": r"stanley cup", "champions league": r"champions league",
}
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec"
SUBJECT_PATTERNS = (
    r"(?i)^\s*will\s+(.+?)\s+win\s+(?:the\s+)?", r"(?i)^\s*will\s+(.+?)\s+qualify\s+", r"(?i)^\s*will\s+(.+?)\s+make\s+(?:the\s+)?", r"(?i)^\s*will\s+(.+?)\s+play\s+in\s+",
    r"(?i)^\s*will\s+(.+?)\s+(?:launch|release|announce|leave|retire|become|get|have|hit|reach)\b", r"(?i)^\s*will\s+(.+?)\s+be\s+",
)
ACTOR_PATTERNS = (
    r"^(?:what|which) countries will (.+?) visit\b", r"^what will (.+?) say\b", r"^what will be said on (?:the\s+(?:first|second|third)\s+)?(.+?) episode\b",
    r"^where will (.+?) meet\b", r"^which countries will (.+?) make (?:new )?trade deals?\b",
)

# Dimensions of what is asked, by their patterns.
DIMENSIONS = {
    "arrest": r"\barrest(?:ed|s|ing)?\b",
    "presidential_run": r"\bannounce\w*\s+(?:a\s+)?presidential\s+(?:run|campaign)\b|\brun\s+for\s+president\b|\brun\s+for\b.{0,45}\bpresidential\s+nomination\b",
    "office_exit": r"\bleave\w*\b.{0,40}\b(?:administration|office|cabinet)\b|\bresign\w*\b|\bout\s+as\b",
    "office_entry": r"\bjoin\w*\b.{0,40}\b(?:administration|cabinet)\b|\bappoint\w*\b.{0,40}\b(?:administration|cabinet)\b",
    "impeachment": r"\bimpeach\w*\b",
    "retirement": r"\bretir\w*\b",
    "album_release": r"\b(?:release|drop)\w*\b.*\balbums?\b|\balbums?\b.*\b(?:release|drop)\w*\b",
    "song_release": r"\b(?:release|drop)\w*\b.*\b(?:songs?|tracks?)\b|\b(?:songs?|tracks?)\b.*\b(?:release|drop)\w*\b",
    "album_market": r"\balbums?\b",
    "song_market": r"\b(?:songs?|tracks?)\b",
    "album_feature": r"\bfeatur\w*\b.{0,50}\balbums?\b",
    "album_chart": r"(?:#\s*\d+|\btop\b|\bnumber one\b|\bmost\b).{0,35}\balbums?\b|\balbums?\b.{0,35}(?:#\s*\d+|\btop\b|\bnumber one\b|\bmost\b)",
    "song_chart": r"(?:#\s*\d+|\btop\b|\bnumber one\b|\bmost\b).{0,35}\b(?:songs?|tracks?)\b|\b(?:songs?|tracks?)\b.{0,35}(?:#\s*\d+|\btop\b|\bnumber one\b|\bmost\b)",
    "artist_ranking": r"(?:#\s*\d+|\btop\b|\bnumber one\b|\bmost\b).{0,50}\bartists?\b|\bartists?\b.{0,50}(?:#\s*\d+|\btop\b|\bnumber one\b|\bmost\b)",
    "token_launch": r"\blaunch\w*\b.*\btokens?\b|\btokens?\b.*\blaunch\w*\b",
    "government_stake": r"\b(?:government|us|u s)\b.{0,40}\b(?:take|buy|acquire)\w*\b.{0,30}\bstake\b|\btake\w*\b.{0,30}\bcontrol\b",
    "ipo": r"\bipos?\b|\binitial public offerings?\b",
    "bankruptcy": r"\bbankrupt\w*\b",
    "acquisition": r"\bacquir\w*\b|\bbuyout\b",
    "scripted_series": r"\bscripted\s+series\b|\bmulti[ -]?episode\b",
    "device_product": r"\bproduct\s+line\b|\b(?:iphone|smartphone|phone|device)\b",
    "country_visit": r"\b(?:countries|country)\b.{0,50}\bvisit\w*\b|\bvisit\w*\b.{0,50}\b(?:countries|country)\b",
    "person_visit_location": r"\bvisit\w*\b",
    "diplomatic_meeting": r"\bmeet\w*\b",
    "conversation_with": r"\btalk\w*\s+to\b|\bspeak\w*\s+with\b",
    "speech_mention": r"\b(?:say|said)\b",
    "legislative_vote": r"\bvote\w*\b.{0,60}\b(?:act|bill|appropriations?|resolution)\b",
    "pardon": r"\bpardon\w*\b",
    "trade_deal": r"\btrade\s+deals?\b",
    "recognition": r"\brecogniz\w*\b",
    "relations_normalization": r"\bnormalize\w*\s+relations\b|\babraham accords?\b",
    "competition_participation": r"\bparticipat\w*\b",
    "player_transfer": r"\b(?:players?|athletes?)\b.{0,45}\btransfer\w*\b|\btransfer\w*\b.{0,45}\b(?:clubs?|teams?)\b",
    "presidential_election": r"\bpresidential\s+election\b",
    "presidential_nomination": r"\b(?:presidential|president)\b.{0,35}\b(?:nominee|nomination)\b|\b(?:nominee|nomination)\b.{0,35}\b(?:presidential|president)\b",
    "medal_award": r"\bmedal\s+of\s+freedom\b",
    "tour_announcement": r"\b(?:announce\w*\s+)?(?:a\s+)?new\s+tour\b",
    "national_chamber_control": r"\bparty\b.{0,30}\b(?:win|control)\w*\b.{0,30}\b(?:house|senate)\b|\bparty\b.{0,30}\b(?:house|senate)\b",
    "individual_legislative_race": r"\b(?:senate|house)\s+(?:race|winner|election)\b|\b[a-z]{2}[ -]?\d{1,2}\b.{0,30}\b(?:house|election|primary)\b",
    "unemployment_metric": r"\bunemployment\b",
    "inflation_metric": r"\binflation\b|\bcpi\b",
    "gdp_metric": r"\bgdp\b|\bgross domestic product\b",
    "bond_role_q": r"\bplay\s+q\b.{0,30}\bjames\s+bond\b",
    "bond_role_bond": r"\b(?:next|play)\b.{0,30}\bjames\s+bond\b",
    "competition_elimination": r"\beliminat\w*\b",
    "competition_finalist": r"\b(?:make|reach|advance\s+to)\s+(?:the\s+)?finals?\b",
    "competition_knockout_advance": r"\badvance\w*\s+to\s+(?:the\s+)?knockout\s+stages?\b",
    "competition_seed": r"\b#?\s*\d+\s+seed\b|\bseed\s+in\b.{0,30}\btournament\b",
    "competition_play_in": r"\bplay[ -]?in\s+tournament\b",
    "playoffs_qualification": r"\b(?:make|reach|qualify\w*\s+for)\b.{0,30}\bplayoffs?\b",
    "round_of_16": r"\bround\s+of\s+16\b",
    "quarterfinal": r"\bquarter[ -]?final\w*\b",
    "stat_era": r"\bera\b",
    "stat_doubles": r"\bdoubles\b",
    "stat_war": r"\bwins?\s+above\s+replacement\b|\bwar\b",
    "stat_rbi": r"\brbis?\b",
    "stat_ops": r"\bops\b",
    "stat_hits": r"\bhits?\s+(?:leader|total)\b|\bmost\s+hits?\b",
    "stat_batting_average": r"\bbatting\s+average\b",
    "stat_triples": r"\btriples?\s+leader\b|\bmost\s+triples?\b",
    "stat_home_runs": r"\bhome\s+runs?\b|\bhomers?\b",
    "stat_stolen_bases": r"\bstolen\s+bases?\b|\bsteals?\s+leader\b",
    "stat_runs": r"\bruns?\s+leader\b|\bmost\s+runs?\b",
    "stat_pitching_wins": r"\bpitching\s+wins?\b|\bwins?\s+leader\b",
    "stat_points": r"\bpoints?\s+per\s+game\b",
    "stat_rebounds": r"\brebounds?\s+per\s+game\b",
    "stat_assists": r"\bassists?\s+per\s+game\b",
    "stat_steals": r"\bsteals?\s+per\s+game\b",
    "stat_blocks": r"\bblocks?\s+per\s+game\b",
    "stat_three_pointers": r"\b(?:three|3)[ -]?pointers?\b|\b3pm\b",
    "award_cy_young": r"\bcy\s+young\b",
    "award_hank_aaron": r"\bhank\s+aaron\b",
    "award_mvp": r"\bmvp\b|\bmost\s+valuable\s+player\b",
    "award_hart": r"\bhart\s+memorial\b",
    "award_art_ross": r"\bart\s+ross\b",
    "award_rocket_richard": r"\brocket.?\s+richard\b",
    "award_calder": r"\bcalder\s+memorial\b",
    "award_vezina": r"\bvezina\b",
    "award_jack_adams": r"\bjack\s+adams\b",
    "award_clutch": r"\bclutch\s+player\b",
    "award_defensive_player": r"\bdefensive\s+player\s+of\s+the\s+year\b",
    "award_most_improved": r"\bmost\s+improved\s+player\b",
    "award_james_norris": r"\b(?:james\s+)?norris\s+(?:memorial\s+)?trophy\b",
    "award_conference_finals_mvp": r"\bconference\s+finals?\s+mvp\b",
    "award_finals_mvp": r"\bfinals?\s+mvp\b",
    "award_comeback_player": r"\bcomeback\s+player\s+of\s+the\s+year\b",
    "award_presidents_trophy": r"\bpresident(?:s|\s+s)?\s+trophy\b",
    "award_selke": r"\b(?:frank\s+j\s+)?selke\s+trophy\b",
    "award_rookie_of_year": r"\brookie\s+of\s+the\s+year\b",
    "award_player_of_year": r"\bplayers?\s+player\s+of\s+the\s+year\b|\bplayer\s+of\s+the\s+year\b",
    "ufc_pound_for_pound": r"\bpound[ -]?for[ -]?pound\b",
    "ufc_weight_title": r"\bufc\b.{0,40}\b(?:flyweight|bantamweight|featherweight|lightweight|welterweight|middleweight|heavyweight|weight)\b.{0,30}\b(?:title|champion)\b",
    "ufc_any_title": r"\bufc\b.{0,40}\b(?:title|champion)\b",
    "division_title": r"\bdivision\s+(?:winner|champion)\b",
    "conference_title": r"\bconference\s+(?:winner|champion)\b",
    "stanley_cup_title": r"\bstanley\s+cup\b",
    "regular_season_title": r"\bregular\s+season\s+(?:winner|champion)\b",
    "conference_tournament_title": r"\b(?:conference|league)\b.{0,45}\btournament\s+(?:winner|champion)\b",
    "national_title": r"\b(?:mens|womens)?\s*college\s+basketball\s+(?:winner|champion)\b|\bncaa\s+tournament\s+(?:winner|champion)\b",
    "majority_loss": r"\blose\w*\b.{0,30}\b(?:house|senate)\s+majority\b",
    "house_seat_count": r"\bhow\s+many\s+house\s+seats\b",
    "not_running_count": r"\bhow\s+many\b.{0,40}\b(?:members|senators)\b.{0,25}\bnot\s+running\b",
    "criminal_charge": r"\bcharg(?:e|ed|es|ing)\b",
    "ai_top_rank": r"\btop[ -]?ranked\s+ai\s+model\b",
    "ai_score_threshold": r"\b(?:hit|reach)\w*\b.{0,20}\b\d{3,4}\b.{0,30}\b(?:arena|benchmark|score)\b",
    "song_performer": r"\b(?:sing|perform)\w*\b.{0,35}\bsong\b",
    "person_of_year": r"\bperson\s+of\s+the\s+year\b",
    "richest_person": r"\brichest\s+(?:person|man|woman)\b",
    "google_search_ranking": r"\bsearch(?:ed|es)?\b.{0,35}\bgoogle\b|\bgoogle\b.{0,35}\bsearch(?:ed|es)?\b",
    "sexiest_person": r"\bsexiest\s+(?:man|woman|person)\b",
    "candidate_nomination": r"\b(?:nominee|nomination)\b|\bprimary\s+winner\b",
    "election_winner": r"\b(?:general\s+|special\s+)?election\s+winner\b|\bwin\w*\b.{0,80}\belection\b",
    "governor_race": r"\b(?:governor|governorship|gubernatorial)\b",
    "attorney_general_race": r"\battorney\s+general\b",
    "district_race": r"\b[a-z]{2}[ -]\d{1,2}\b",
    "political_endorsement": r"\bendorse\w*\b",
    "party_leader_election": r"\b(?:senate|house)\b.{0,30}\bleader\s+election\b",
    "runoff_advancement": r"\badvance\w*\s+to\b.{0,30}\brunoff\b",
    "primary_advancement": r"\badvance\w*\s+from\b.{0,40}\bprimary\b|\bprimary\s+advancers?\b",
    "primary_ranked_finish": r"\b(?:\d+(?:st|nd|rd|th)|first|second|third)\s+place\b.{0,60}\bprimary\b|\bprimary\b.{0,60}\b(?:\d+(?:st|nd|rd|th)|first|second|third)\s+place\b|\bplace\s+(?:first|second|third)\b.{0,60}\bprimary\b|\bprimary\b.{0,60}\bplace\s+(?:first|second|third)\b",
    "first_round_winner": r"\b(?:1st|first)\s+round\s+winner\b",
    "cover_athlete": r"\bcover\s+of\b.{0,35}\b(?:2k|madden|fc|fifa|nhl|mlb)\w*\b",
    "ipo_announcement": r"\b(?:announce|file|files|filed|filing)\w*\b.{0,30}\bipo\b|\bipo\b.{0,30}\b(?:announce|file|files|filed|filing)\w*\b",
    "ipo_first": r"\bipo\b.{0,30}\bfirst\b|\bfirst\b.{0,30}\bipo\b",
    "largest_ipo": r"\blargest\s+ipo\b|\bipo\b.{0,35}\b(?:largest|market\s+cap)\b",
    "fed_governor_role": r"\b(?:federal\s+reserve|fed)\s+governor\b",
    "fed_chair_role": r"\b(?:federal\s+reserve|fed)\s+(?:chair|chairman|chairwoman)\b",
    "award_total_count": r"\b(?:most|how\s+many)\s+(?:oscars?|academy\s+awards?)\b",
    "award_category_win": r"\b(?:academy\s+awards?|oscars?)\b.{0,80}\bbest\s+[a-z]|\bbest\s+[a-z].{0,80}\b(?:academy\s+awards?|oscars?)\b",
}
COMPETITIONS = {
    "womens_ucl": r"\bwomens?\s+(?:uefa\s+)?champions\s+league\b", "ucl": r"\b(?:uefa\s+)?champions\s+league\b", "europa_league": r"\b(?:uefa\s+)?europa\s+league\b",
    "europa_conference_league": r"\b(?:uefa\s+)?(?:europa\s+)?conference\s+league\b", "fifa_world_cup": r"\bfifa\s+world\s+cup\b", "mls": r"\bmls\b|\bmajor\s+league\s+soccer\b",
    "fa_cup": r"\bfa\s+cup\b", "carabao_cup": r"\bcarabao\s+cup\b", "epl": r"\benglish\s+premier\s+league\b|\bepl\b", "serie_a": r"\bserie\s+a\b", "ligue_1": r"\bligue\s+1\b",
    "greece_super_league": r"\bgreece\s+super\s+league\b", "masters_golf": r"\b(?:the\s+)?masters(?:\s+tournament)?\b", "french_open": r"\bfrench\s+open\b", "wimbledon": r"\bwimbledon\b",
    "us_open_tennis": r"\bus\s+open\b.{0,20}\btennis\b|\b(?:mens|womens)\s+us\s+open\s+winner\b", "indian_wells": r"\bindian\s+wells\b", "calendar_grand_slam": r"\bcalendar\s+grand\s+slam\b",
    "belgian_pro_league": r"\bbelgian\s+pro\s+league\b", "wbc": r"\bworld\s+baseball\s+classic\b|\bwbc\b", "mlb": r"\bmajor\s+league\s+baseball\b|\bmlb\b|\bpro\s+baseball\b",
    "nba": r"\bnba\b|\bpro\s+basketball\b", "ncaa_basketball": r"\bncaab\b|\bncaa\b.{0,25}\bbasketball\b|\bcollege\s+basketball\b", "ncaa_wcc": r"\bwcc\b", "ncaa_big_12": r"\bbig\s+12\b",
    "ncaa_acc": r"\bacc\b.{0,35}\b(?:basketball|conference|champion|winner)\b", "nfl": r"\bnfl\b|\bpro\s+football\b", "ncaa_football": r"\bncaaf\b|\bncaa\b.{0,25}\bfootball\b|\bcollege\s+football\b",
    "nhl": r"\bnhl\b|\bpro\s+hockey\b", "six_nations": r"\bsix\s+nations\b",
}
AWARD_CATEGORIES = {
    "supporting_actor": r"\bsupporting\s+actor\b|\bmale\s+actor\b.{0,35}\bsupporting\s+role\b", "supporting_actress": r"\bsupporting\s+actress\b|\bfemale\s+actor\b.{0,35}\bsupporting\s+role\b",
    "original_screenplay": r"\boriginal\s+screenplay\b", "adapted_screenplay": r"\badapted\s+screenplay\b", "original_score": r"\boriginal\s+score\b|\bbest\s+music\b.{0,25}\bscore\b",
    "original_song": r"\boriginal\s+song\b", "documentary_feature": r"\bdocumentary\s+feature\b", "international_feature": r"\binternational\s+feature\b", "animated_short": r"\banimated\s+short\b",
    "production_design": r"\bproduction\s+design\b", "costume_design": r"\bcostume\s+design\b", "makeup_hairstyling": r"\bmakeup\b.{0,20}\bhairstyling\b", "film_editing": r"\bfilm\s+editing\b",
    "visual_effects": r"\bvisual\s+effects\b", "cinematography": r"\bcinematography\b", "best_casting": r"\bbest\s+casting\b", "best_director": r"\bbest\s+director\b",
    "best_picture": r"\bbest\s+picture\b", "best_actor": r"\bbest\s+actor\b", "best_actress": r"\bbest\s+actress\b", "best_sound": r"\bbest\s+sound\b",
}
SIMPLE_SCOPES = {
    "president": r"\b(?:president|presidential)\b", "senate": r"\b(?:senate|senators?)\b", "house": r"\b(?:house|congress|congressional)\b", "governor": r"\b(?:governor|gubernatorial|governorship)\b",
    "mayor": r"\b(?:mayor|mayoral)\b", "vice_president": r"\bvp\b|\bvice\s+president(?:ial)?\b", "seat_count": r"\bseats?\b", "city_count": r"\b(?:city|cities)\b",
    "winner": r"\b(?:win|winner|champion)\b", "qualifier": r"\b(?:qualify|qualifiers?)\b", "golden boot": r"golden boot", "top_scorer": r"\btop\s+scorer\b", "semifinal": r"\bsemi[ -]?final\b",
    "relegation": r"\brelegat\w*\b", "top_finish": r"\btop\s+(?:\d+|four|five|ten)\b", "undefeated": r"\bundefeated\b", "competition_ranking": r"\b(?:ranked|rankings?|poll)\b",
    "platform:spotify": "spotify", "platform:billboard": "billboard", "platform:youtube": "youtube", "platform:apple music": "apple music", "platform:ifpi": "ifpi", "platform:netflix": "netflix",
    "period:annual": r"\b(?:this year|annual|yearly|in 20\d{2})\b", "period:monthly": rf"\b(?:{MONTHS}|monthly)\b", "period:weekly": r"\b(?:week|weekly)\b", "period:daily": r"\b(?:day|daily)\b",
    "party:democratic": r"\b(?:democratic|democrat)\b", "party:republican": r"\b(?:republican|gop)\b", "sport_level:professional": r"\b(?:nba|nfl|nhl|mlb|pro\s+(?:basketball|football|hockey|baseball))\b",
    "sport_level:college": r"\b(?:ncaa[bf]?|ncaab|college\s+(?:basketball|football)|wcc|big\s+12)\b", "gender:women": r"\bwomens?\b",
    "award_show:oscars": r"\b(?:oscars?|academy\s+awards?)\b", "award_show:actor_awards": r"\b(?:actor\s+awards?|screen\s+actors?\s+guild|sag\s+awards?)\b",
}
EVENT_MARKERS = {
    "NBA": ("competition:nba", "sport_level:professional"), "NFL": ("competition:nfl", "sport_level:professional"), "NHL": ("competition:nhl", "sport_level:professional"),
    "MLB": ("competition:mlb", "sport_level:professional"), "NCAAB": ("competition:ncaa_basketball", "sport_level:college"), "NCAAF": ("competition:ncaa_football", "sport_level:college"),
    "WBC": ("competition:wbc", "sport_level:professional"),
}

# Sets of dimensions of which two outcomes must share one if both have any.
_STATS = [
    "stat_era", "stat_doubles", "stat_war", "stat_rbi", "stat_ops", "stat_hits", "stat_batting_average", "stat_triples",
    "stat_home_runs", "stat_stolen_bases", "stat_runs", "stat_pitching_wins", "stat_points", "stat_rebounds", "stat_assists",
    "stat_steals", "stat_blocks", "stat_three_pointers",
]
_AWARDS = [
    "award_cy_young", "award_hank_aaron", "award_mvp", "award_hart", "award_art_ross", "award_rocket_richard", "award_calder",
    "award_vezina", "award_jack_adams", "award_clutch", "award_defensive_player", "award_most_improved", "award_james_norris",
    "award_conference_finals_mvp", "award_finals_mvp", "award_comeback_player", "award_presidents_trophy", "award_selke",
    "award_rookie_of_year", "award_player_of_year",
]
_TITLES = [
    "division_title", "conference_title", "stanley_cup_title", "regular_season_title", "conference_tournament_title",
    "national_title", "cover_athlete", "playoffs_qualification", "player_transfer",
]
EXCLUSIVE = [
    [
    "arrest", "presidential_run", "presidential_election", "presidential_nomination", "office_exit", "office_entry", "impeachment",
    "retirement", "medal_award", "criminal_charge", "pardon", "runoff_advancement", "cover_athlete",
],
    ["album_release", "song_release"],
    ["album_market", "song_market"],
    ["album_release", "song_release", "album_feature", "album_chart", "song_chart", "artist_ranking", "tour_announcement", "song_performer"],
    ["token_launch", "government_stake", "ipo", "bankruptcy", "acquisition"],
    ["country_visit", "diplomatic_meeting", "pardon", "trade_deal", "recognition", "relations_normalization"],
    ["scripted_series", "device_product"],
    ["national_chamber_control", "individual_legislative_race", "majority_loss"],
    ["unemployment_metric", "inflation_metric", "gdp_metric"],
    ["bond_role_q", "bond_role_bond"],
    ["winner", "competition_elimination"],
    ["winner", "qualifier", "round_of_16", "quarterfinal"],
    [*_STATS, *_AWARDS, *_TITLES],
    ["ufc_pound_for_pound", "ufc_weight_title", "ufc_any_title"],
    ["house_seat_count", "not_running_count"],
    ["ai_top_rank", "ai_score_threshold"],
    ["person_of_year", "richest_person", "google_search_ranking", "sexiest_person", "artist_ranking", "album_chart", "song_chart"],
    ["candidate_nomination", "election_winner"],
    ["candidate_nomination", "political_endorsement", "party_leader_election"],
    ["candidate_nomination", "political_endorsement", "primary_advancement", "primary_ranked_finish", "first_round_winner"],
    ["governor_race", "attorney_general_race", "district_race", "party_leader_election"],
    ["election_winner", "runoff_advancement"],
    ["overall_election_winner", "first_round_winner", "runoff_advancement"],
    ["conversation_with", "diplomatic_meeting", "person_visit_location", "legislative_vote", "office_entry", "speech_mention"],
    ["ipo_announcement", "ipo_first", "largest_ipo"],
    ["fed_governor_role", "fed_chair_role"],
    ["award_total_count", "award_category_win"],
]
NAMESPACES = [
    "platform:", "award_show:", "award_category:", "speech_context:", "manager_target:", "competition:", "sport_level:", "gender:",
    "competition_stage:", "deadline_year:", "party:", "weight_class:", "legislative_level:",
]
OFFICES = ["president", "senate", "house", "governor", "mayor", "vice_president"]
