"""The vocabulary that a user may tune: topic words, themes, stop words, variants, boilerplate, sources."""

from __future__ import annotations

from dataclasses import dataclass, field

#: What may stand before a word in every regex dialect at hand: the start, or anything but a letter, digit or underscore.
LEFT, RIGHT = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


@dataclass(frozen=True)
class Theme:
    id: int
    label: str
    pattern: str
    rank: int


@dataclass(frozen=True)
class Source:
    name: str
    code: str
    label: str
    home: str
    rank: int


@dataclass(frozen=True)
class Vocabulary:
    """stems match at the start of a word, words match whole; themes match anywhere."""

    stems: tuple[str, ...]
    words: tuple[str, ...]
    themes: tuple[Theme, ...]
    other: str = "Other"
    stop: tuple[str, ...] = ()
    more_stop: tuple[str, ...] = ()
    variants: dict[str, str] = field(default_factory=dict)
    boilerplate: tuple[str, ...] = ()
    sources: tuple[Source, ...] = ()

    @property
    def topic(self) -> str:
        """A regex for Java and RE2 alike that finds a topic word, ignoring case."""
        whole = [w + RIGHT for w in self.words]
        return f"(?i){LEFT}(?:{'|'.join([*self.stems, *whole])})"

    @property
    def labels(self) -> list[str]:
        return [t.label for t in self.themes] + [self.other]


# The news vocabulary that published results rest on.
_STEMS = (
    "ukrain", "russ", "kremlin", "putin", "moscow", "belarus", "defen[cs]e", "militar", "nato", "warfare", "drone", "china", "chinese",
    "beijing", "taiwan", "weapon", "missile", "army", "troop", "soldier", "sanction", "wagner", "zelensky", "invasion", "espionage", "spy",
    "sabotag", "cyber", "airspace", "submarine", "frigate", "warship", "warplane", "hybrid", "mobilis", "mobiliz", "conscript", "deepfake",
    "disinfo", "misinform", "terror", "radicali[sz]", "extremis", "readiness", "preparedness", "resilience", r"civil\s+defen[cs]e",
    "shelter", "evacuat", "naval", "navy", "tank", "migrant", "threat", r"special\s+forces", "false.?flag", "hack",
    r"intelligence\s+service", "counter.?intelligence", "artillery", "shelling", r"front[\s-]?line", "refugee", "border",
)
_WORDS = ("war", "cia", "fsb", "gru", "kgb")
_THEMES = (
    ("Ukraine", "ukrain|zelensk|kyiv|kharkiv|donbas|donetsk|kherson|zaporizh|odesa", 2),
    ("Russia & Kremlin", "russ|kremlin|putin|moscow|wagner|lavrov|medvedev", 2),
    ("NATO & defence", r"nato|defen[cs]e|militar|troop|soldier|brigade|deploy|exercise|weapon|missile|artillery|himars|atacms|warship|frigate|submarine|\barmy\b|rearm|conscript|mobilis|mobiliz|readiness|preparedness|resilience|civil\s+defen[cs]e|shelter|evacuat|naval|navy|\btank|special\s+forces", 1),
    ("Drones & airspace", r"drone|airspace|uav|incursion|airport|warplane|aircraft|\bjet\b", 2),
    ("Border & migration", r"border|migrant|refugee|belarus|frontier|\bfence|smuggl|crossing|barbed", 2),
    ("Hybrid warfare", r"sabotag|cyber|espionage|\bspy|hybrid|disinfo|deepfake|misinform|propaganda|interfer|meddl|cognitive|influence\s+oper|jamming|\bgps\b|undersea|\bcable|shadow fleet|provocation|coercion|terror|radicali[sz]|extremis|false.?flag|\bhack|counter.?intelligence|intelligence\s+service|\bcia\b|\bfsb\b|\bgru\b|\bkgb\b", 2),
    ("China & Indo-Pacific", r"\bchina\b|chinese|beijing|taiwan|xi jinping|indo.?pacific|south china", 2),
)
_EXTRA_STOP = (
    "text press select suggested correction editor send follow facebook twitter newsletter subscribe sign cookies err lrt lsm news said says "
    "according monday tuesday wednesday thursday friday saturday sunday year years wants make did"
)
_FREQUENCY_STOP = (
    "time state states way week day days people month today year years country countries new also first two lithuania latvia estonia lithuanian "
    "latvian estonian baltic baltics vilnius tallinn riga added situation possible according public january february march april may june july "
    "august september october november december does including used"
)
_LABEL_STOP = "say says said told reports report reported week government minister ministry official officials plan plans"
_VARIANTS = {
    "russian": "russia", "russians": "russia", "ukrainian": "ukraine", "ukrainians": "ukraine", "belarus": "belarus", "belarusian": "belarus",
    "belarusians": "belarus", "chinese": "china", "estonian": "estonia", "latvian": "latvia", "lithuanian": "lithuania", "defense": "defence",
    "militarily": "military", "ministries": "ministry", "ministers": "minister",
}
_BOILERPLATE = (
    "suggested correction", "select text and press", "send a suggested", "to the editor", "follow err", "follow lrt", "follow lsm", "sign up",
    "newsletter", "subscribe", "cookie", "all rights reserved", "advertisement", "read more", "related articles", "share this", "download the",
    "on facebook", "on twitter", "©",
)
_SOURCES = (
    ("err_ee", "EE", "ERR (Estonia)", "https://news.err.ee/"),
    ("lrt_lt", "LT", "LRT (Lithuania)", "https://www.lrt.lt/en/news-in-english"),
    ("lsm_lv", "LV", "LSM (Latvia)", "https://eng.lsm.lv"),
)
ESCALATION = (
    "military escalation and the threat of war", "russian attack, shelling, missile strikes and invasion", "troop mobilisation, conscription and armed conflict",
    "airspace violation, drone incursion and sabotage", "rising tension, provocation and hostile threats",
)
DEESCALATION = (
    "ceasefire and peace negotiations", "diplomacy, dialogue and international cooperation", "de-escalation and easing of tensions",
    "peaceful resolution, stability and security guarantees", "agreement, partnership and lifting of sanctions",
)
# End of the fixed values.

NEWS = Vocabulary(
    stems=_STEMS,
    words=_WORDS,
    themes=tuple(Theme(i, label, "(?i)" + pattern, rank) for i, (label, pattern, rank) in enumerate(_THEMES)),
    other="Other defence",
    stop=tuple(_EXTRA_STOP.split()),
    more_stop=tuple(_FREQUENCY_STOP.split()),
    variants=_VARIANTS,
    boilerplate=_BOILERPLATE,
    sources=tuple(Source(n, c, label, home, i) for i, (n, c, label, home) in enumerate(_SOURCES)),
)
LABEL_STOP = tuple(_LABEL_STOP.split())


def english_stop_words() -> list[str]:
    """Spark's own list; needs a running session."""
    from pyspark.ml.feature import StopWordsRemover

    return sorted(StopWordsRemover.loadDefaultStopWords("english"))


#: For tables of invented prose: themes over its frequent syllables, so that ties, several labels and fall-backs all occur.
PROSE = Vocabulary(
    stems=("thres", "hation", "ungh", "ciónad", "eauxl", "war[ae]"),
    words=("for", "und", "por"),
    themes=tuple(
        Theme(i, label, pattern, rank)
        for i, (label, pattern, rank) in enumerate(
            [("th", "(?i)the|that", 2), ("ion", "(?i)tion", 2), ("broad", "(?i)er|in|de", 1), ("wh", "(?i)wh|ou", 2), ("es", "(?i)ción|mente", 2), ("ger", "(?i)sch|ung", 2), ("fr", "(?i)eau|ell", 2)]
        )
    ),
    stop=("the", "of", "and", "to", "in", "is", "de", "la", "le", "que", "der", "die", "und", "en", "a"),
    more_stop=("that", "with", "for", "this"),
    variants={"ering": "er", "thes": "the", "inges": "ing"},
    boilerplate=("cookie", "sign up", "subscribe"),
)
