"""Text measures and detectors, in two families: those that rules are checked with and those that
rules are mined with. They differ on purpose (word counts, bullets, emoji, citations)."""

from __future__ import annotations

# Patterns of the text rules.
WORD = r"[\p{L}\p{N}_]+"
SPACE = r"[\s\p{Z}\x{85}]"
SPACE_NOT = r"[^\s\p{Z}\x{85}]"
NOT_SPACE = r"[^\s\p{Z}\x{85}]"
HAN = r"[\x{4e00}-\x{9fff}]"
EMOJI_CHECKED = r"[\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}]"
EMOJI_MINED = r"[\x{10000}-\x{10FFFF}]"
BEFORE, AFTER = r"(?:^|[^\p{L}\p{N}_])", r"(?:[^\p{L}\p{N}_]|$)"
FIRST_PERSON = BEFORE + r"(?:i|me|my|we|our|us)" + AFTER
NUMERIC_CITE = r"\[\s*[0-9]{1,4}(?:\s*[-,;]\s*[0-9]{1,4})*\s*\]"
AUTHOR_CITE = r"\([A-Z][A-Za-z.\-]+(?:\s+et\s+al\.)?,\s*[0-9]{4}[a-z]?\)"
REF_CITE = r"\[([A-Za-z][A-Za-z0-9_-]*[0-9]+)\]"
SUBPOINT = r"^\s*(?:[-*]|[0-9]+[.)])\s+.+"
NUMBERED = r"^\s*[0-9]+[.)]\s+.+"
HEADING = r"^(#{1,6})\s+\S"
BULLET = r"^\s*([-*])\s+.+"
DECIMAL = BEFORE + r"[0-9]+\.([0-9]+)"
ISO_DATE = BEFORE + r"[0-9]{4}-[0-9]{2}-[0-9]{2}" + AFTER
LONG_DATE = BEFORE + r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+[0-9]{1,2},\s+[0-9]{4}" + AFTER
CONTRACTIONS_CHECKED = (
    "don't doesn't didn't can't cannot won't wouldn't shouldn't couldn't mustn't i'm i've i'll i'd it's it'd it'll that's there's "
    "we're we've we'll we'd they're they've they'll they'd you're you've you'll you'd isn't aren't wasn't weren't hasn't haven't hadn't"
).split()
CONTRACTIONS_MINED = "don't doesn't can't won't i'm it's that's we're they're i've you've isn't aren't weren't hasn't haven't shouldn't couldn't wouldn't".split()
STOPWORDS = (
    "a an the and or but if then else when while for to of in on at by from as is are was were be been being this that these those "
    "with without into within across over under between among can could should would may might must do does did done doing have has "
    "had having not no nor so such very more most other same own just also than too rather quite"
).split()
NUMERIC_CITE_MINED = r"\[[0-9]{1,3}\]"
AUTHOR_CITE_MINED = r"\([A-Z][A-Za-z]+,?\s+[0-9]{4}\)"
BULLET_MINED = r"^([-*]|[0-9]+\.)\s+"
TOKEN_MINED = r"[a-z][a-z'\-]+"
NUMBERED_MINED = r"(?:^|\n)\s*(?:[0-9]+[.)]|[A-Za-z][.)])\s+"
SEQUENCE_CUE = r"(?i)" + BEFORE + r"(?:first|second|third|then|next|afterward|finally|step\s*[0-9]+)" + AFTER
POLITE_ZH = ("请你(?:帮我)?", "请帮我", "请为我", "麻烦你", "我想让你", "能否帮我", "可以帮我")
POLITE_EN = ("please", "could you", "can you", "would you", "i would like you to", "i want you to", "help me")
WISH_ZH = "^(?:我|我想|我需要|我希望|我希望你|我想让你|我想要你|我想请你)[^,，。:.：]*"
WISH_EN = r"^(?i:i\s+need\s+you\s+to|i\s+want\s+you\s+to|i\s+would\s+like\s+you\s+to)\s+"
NEGATABLE = (" is ", " are ", " should ", " must ")




def either(words) -> str:
    return r"(?i)" + BEFORE + "(?:" + "|".join(words) + ")" + AFTER


def lines(d, pattern: str) -> str:
    return d.multiline + pattern


def strip(d, t: str) -> str:
    return d.replace_all(t, rf"^{SPACE}+|{SPACE}+$", "")


def words(d, t):
    return d.count(t, WORD)


def words_mined(d, t):
    """Words plus Han characters, each of which counts on top of its run."""
    return f"({d.count(t, WORD)} + {d.count(t, HAN)})"


def chars(d, t):
    return f"CAST(length({t}) AS BIGINT)"


def chars_dense(d, t):
    return d.count(t, NOT_SPACE)


def occurrences(d, t, s):
    """Non-overlapping literal occurrences; an empty literal occurs at every gap."""
    return f"CASE WHEN length({s}) = 0 THEN {chars(d, t)} + 1 ELSE CAST((length({t}) - length(replace({t}, {s}, ''))) / greatest(length({s}), 1) AS BIGINT) END"


def markers(d, t):
    return d.concat(d.all(t, NUMERIC_CITE), d.all(t, AUTHOR_CITE), d.all(t, REF_CITE))


def cited(d, t):
    """Distinct lower-cased reference ids."""
    return d.distinct(d.map(d.all(t, REF_CITE, 1), "x", "lower(x)"))


def paragraphs_checked(d, t):
    return d.size(d.keep(d.split(strip(d, t), r"\n\s*\n+"), "x", d.has("x", NOT_SPACE)))


def paragraphs_mined(d, t, strip_first=True):
    return d.size(d.keep(d.split(strip(d, t) if strip_first else t, r"(?:\r?\n){2,}"), "x", d.has("x", NOT_SPACE)))


def heading_levels(d, t):
    return d.map(d.all(t, lines(d, HEADING), 1), "x", "CAST(length(x) AS BIGINT)")


def bullets(d, t):
    return d.all(t, lines(d, BULLET), 1)


def decimals(d, t):
    """Fraction parts of decimal numbers that end at a word boundary."""
    return d.all(d.replace_all(t, r"([0-9]+\.[0-9]+[\p{L}_][\p{L}\p{N}_]*)", "x"), DECIMAL, 1)


def language(d, t):
    han, letters = d.count(t, HAN), d.count(t, r"[A-Za-z\x{4e00}-\x{9fff}]")
    return f"CASE WHEN {han} >= 25 AND {han} >= 0.4 * greatest(1, {letters}) THEN 'zh' ELSE 'en' END"


def is_english(d, t):
    bare = d.count(t, r"[^\x00-\x7F]")
    return f"({bare} = 0 OR {d.count(t, '[A-Za-z]')} >= 5 * {bare})"


def normalised(d, t):
    """CRLF to LF, tabs to blanks, three or more blanks to one, three or more line feeds to two, stripped."""
    t = d.replace_all(t, r"\r\n?", "\n")
    t = d.replace_all(t, r"\t", " ")
    t = d.replace_all(t, r" {3,}", " ")
    return strip(d, d.replace_all(t, r"\n{3,}", "\n\n"))


def squeezed(d, t):
    t = d.replace_all(t, r"\r\n?", "\n")
    t = d.replace_all(t, r"[ \t]+", " ")
    return strip(d, d.replace_all(t, r"\n{3,}", "\n\n"))


def clipped(d, t, n: int):
    return "''" if n <= 0 else d.prefix(t, n)


def clipped_dots(d, t, n: int):
    if n <= 0:
        return t
    short = d.replace_all(d.prefix(t, max(0, n - 3)), SPACE + "+$", "")
    dots = f"concat({short}, '...')"
    return f"CASE WHEN length({t}) > {n} THEN {dots} ELSE {t} END"


def slug(d, t):
    s = d.replace_all(d.replace_all(d.lower(t), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    return f"CASE WHEN {s} = '' THEN 'variant' ELSE {s} END"


def condition(d, t):
    """Statement of a condition: no leading If, capitalised, ending with a full stop."""
    bare = strip(d, d.replace_all(strip(d, t), r"^(?i:if) ", ""))
    stop = f"CASE WHEN {d.ends(bare, repr('.'))} THEN '' ELSE '.' END"
    return f"CASE WHEN {bare} = '' THEN '' ELSE concat({d.capital(f'substring({bare}, 1, 1)')}, substring({bare}, 2), {stop}) END"


def negated(d, t):
    """The statement with `not` after its first auxiliary, tried in a fixed order."""
    s = d.replace_all(condition(d, t), r"[.]+$", "")
    cases = " ".join(
        f"WHEN {d.contains(s, repr(a))} THEN concat(substring({s}, 1, {at} + {len(a) - 1}), 'not ', substring({s}, {at} + {len(a)}), '.')"
        for a in NEGATABLE
        for at in [f"instr({s}, {a!r})"]
    )
    return f"CASE WHEN {s} = '' THEN '' {cases} ELSE concat('It is not the case that ', {d.lower(s)}, '.') END"


def polite(d, t):
    """Polite openings taken off one after another, each once."""
    t = strip(d, t)
    for p in POLITE_ZH:
        t = d.replace_all(t, "^" + p, "")
    for p in POLITE_EN:
        t = d.replace_all(t, "^(?i:" + p.replace(" ", r"\s+") + r")\s+", "")
    return strip(d, t)


def first_sentence(d, t):
    """First sentence of the first paragraph."""
    para = strip(d, d.item(d.split(strip(d, t), r"\n\n"), 1))
    short = d.first(para, rf"^([\s\S]*?[。！？!?.]){SPACE}", 1)
    return strip(d, f"CASE WHEN {d.has(para, rf'[。！？!?.]{SPACE}')} THEN {short} ELSE {para} END")


def imperative(d, t):
    """An instruction form: wishes taken off, Analyze put before what does not begin with a plain word."""
    s = strip(d, t)
    u = d.replace_all(d.replace_all(s, WISH_ZH, ""), WISH_EN, "")
    first = rf"^{SPACE}*[A-Za-z]+(?:{SPACE}|$)"
    return f"CASE WHEN {s} = '' THEN 'Analyze the given topic.' WHEN {d.has(u, first)} THEN {u} WHEN {u} = '' THEN 'Analyze the given topic.' ELSE concat('Analyze ', {u}) END"


def tokens(d, t):
    """Distinct lower-cased word tokens."""
    return d.distinct(d.all(d.lower(t), r"[a-z0-9']+"))


def logic(d, t):
    chain = f"(CASE WHEN {d.has(t, SEQUENCE_CUE)} THEN 2 ELSE 0 END + CASE WHEN {d.has(t, NUMBERED_MINED)} THEN 2 ELSE 0 END)"
    both = f"(CASE WHEN {d.has(t, lines(d, '^' + r'\s*[-*]\s+'))} THEN 1 ELSE 0 END + CASE WHEN {occurrences(d, t, repr(';'))} >= 2 THEN 1 ELSE 0 END)"
    return f"CASE WHEN {chain} - {both} >= 2 THEN 'sub-chain' ELSE 'AND' END"


def forbidden_symbol(d, t):
    return "CASE " + " ".join(f"WHEN NOT {d.contains(t, repr(s))} THEN '{s}'" for s in (",", ":", "?", "!")) + " END"
