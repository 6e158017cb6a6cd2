"""Secret scan: fixed patterns plus a randomness test battery, in DataFrame expressions only.

Base kinds (assign, access, hex) are fixed patterns. Beside them every maximal token of 20 or more
encoding characters with letters and digits is tested against the null that its symbols are drawn
at random from the alphabet of its inferred encoding: a chi-squared test of uniformity, a runs test
about the middle of the alphabet and a lag-1 serial correlation test, combined by Fisher's method.
Random tokens have uniform p-values, ordinary ones pile up near zero. Within each class of encoding
and token length (powers of two, since short tokens have little power) the share above one half
estimates how many tokens are random; the least p-value threshold whose estimated false discovery
rate is at most ALPHA decides which are reported as kind `random`. A class without such a threshold
reports nothing. The counts are of all tokens of the table, gathered as a histogram of fixed size.

Positions: split() around a pattern and regexp_extract_all() of it give pieces and matches in
turn, and running sums of their lengths (in code points, in blocks so that work stays near linear)
are the spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import table, text_or_empty

#: The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "random")

#: '=' ends a token (as padding) and may stand before one, as in KEY=value.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Alphabets in the order in which encodings are tried.
ALPHABETS = {
    "hex": ("^[0-9a-f]+$", "0123456789abcdef"),
    "hexu": ("^[0-9A-F]+$", "0123456789ABCDEF"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": ("^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    "base36u": ("^[A-Z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    "base64": ("^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": ("^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}
ALPHA = 0.05
BINS = 20
BLOCK = 128
#: Tokens longer than this are tested as a whole too, but share one length class.
LONGEST_CLASS = 24

SPAN = "struct<kind:int,s:int,e:int>"


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def located(text: str, pattern: str, kind: int, extra: str = "named_struct('x', 0)") -> Column:
    """Array of spans of `pattern` in column `text`: struct(kind, s, e, x), s and e in code points.

    extra: SQL of a struct column per match, given `m`, the match's text.
    """
    lit = _literal(pattern)
    lens = f"zip_with(slice(split({text}, {lit}, -1), 1, size(hits)), hits, (p, m) -> named_struct('a', length(p), 'b', length(m), 'm', m))"
    block = f"slice(lens, b * {BLOCK} + 1, {BLOCK})"
    total = "aggregate({}, 0, (t, y) -> t + y.a + y.b)"
    inner = (
        f"aggregate({block}, named_struct('p', aggregate(slice(totals, 1, b), 0, (t, y) -> t + y), 'out', CAST(array() AS array<struct<s:int,e:int,m:string>>)),"
        " (t, y) -> named_struct('p', t.p + y.a + y.b, 'out', array_append(t.out, named_struct('s', t.p + y.a, 'e', t.p + y.a + y.b, 'm', y.m))), t -> t.out)"
    )
    blocks = f"sequence(0, CAST(ceil(size(hits) / {BLOCK}) AS INT) - 1)"
    with_totals = f"transform(array(transform({blocks}, b -> {total.format(block)})), totals -> flatten(transform({blocks}, b -> {inner})))[0]"
    with_lens = f"transform(array({lens}), lens -> {with_totals})[0]"
    found = f"transform({with_lens}, y -> transform(array(y.m), m -> named_struct('kind', {kind}, 's', y.s, 'e', y.e, 'x', {extra}))[0])"
    return F.expr(f"transform(array(regexp_extract_all({text}, {lit}, 0)), hits -> IF(size(hits) = 0, array(), {found}))[0]")


def _upper_tail(z: str) -> str:
    """P(Z > z) of a standard normal (Abramowitz and Stegun 26.2.17; error below 1e-7)."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    poly = f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429)))))"
    tail = f"(exp(-({z}) * ({z}) / 2) / 2.5066282746310002 * {poly})"
    return f"IF({z} >= 0, {tail}, 1 - {tail})"


def _bound(name: str, value: str, body: str) -> str:
    """let name = value in body"""
    return f"transform(array({value}), {name} -> {body})[0]"


def battery_sql(token: str, alphabet: str) -> str:
    """Combined p-value (double) of the three tests for a token over an alphabet, both SQL strings."""
    chi = (
        f"(aggregate(transform(split({alphabet}, ''), c -> CAST(length({token}) - length(replace({token}, c, '')) AS DOUBLE)), 0D, (t, y) -> t + y * y)"
        f" * length({alphabet}) / length({token}) - length({token}))"
    )
    df = f"(length({alphabet}) - 1)"
    wh = f"((power(greatest({chi}, 1e-9D) / {df}, 1 / 3D) - (1 - 2D / (9 * {df}))) / sqrt(2D / (9 * {df})))"
    p_chi = _bound("zc", wh, _upper_tail("zc"))
    ups = f"aggregate(v, 0, (t, y) -> t + IF(2 * y >= length({alphabet}), 1, 0))"
    runs = (
        f"aggregate(v, named_struct('r', 0, 'w', -1), (t, y) -> named_struct('r', t.r + IF(t.w <> IF(2 * y >= length({alphabet}), 1, 0), 1, 0),"
        f" 'w', IF(2 * y >= length({alphabet}), 1, 0)), t -> t.r)"
    )
    mu = "(2D * up * (n - up) / n + 1)"
    var = f"(({mu} - 1) * ({mu} - 2) / (n - 1))"
    z_runs = f"IF(up = 0 OR up = n OR {var} <= 0, 9D, ({runs} - {mu}) / sqrt(greatest({var}, 1e-9D)))"
    p_runs = _bound("up", ups, _bound("zr", z_runs, f"2 * {_upper_tail('abs(zr)')}"))
    mean = "(aggregate(v, 0D, (t, y) -> t + y) / n)"
    lagged = (
        "aggregate(v, named_struct('prev', CAST(NULL AS DOUBLE), 'xy', 0D, 'xx', 0D),"
        " (t, y) -> named_struct('prev', y - mean, 'xy', t.xy + coalesce(t.prev * (y - mean), 0D), 'xx', t.xx + (y - mean) * (y - mean)),"
        " t -> IF(t.xx = 0, 1D, t.xy / t.xx))"
    )
    z_serial = f"(({lagged} + 1D / n) * sqrt(CAST(n AS DOUBLE)))"
    p_serial = _bound("mean", mean, _bound("zs", z_serial, f"2 * {_upper_tail('abs(zs)')}"))
    fisher = f"-(ln(greatest({p_chi}, 1e-12D)) + ln(greatest({p_runs}, 1e-12D)) + ln(greatest({p_serial}, 1e-12D)))"
    p = _bound("half", fisher, "exp(-half) * (1 + half + half * half / 2)")
    return _bound("v", f"transform(split({token}, ''), c -> locate(c, {alphabet}) - 1)", _bound("n", f"length({token})", p))


def _encoding_sql(token: str) -> str:
    tests = " ".join(f"WHEN {token} RLIKE '{rule}' THEN '{name}'" for name, (rule, _) in ALPHABETS.items())
    return f"CASE {tests} END"


def _alphabet_sql(enc: str) -> str:
    return "CASE " + " ".join(f"WHEN {enc} = '{name}' THEN '{symbols}'" for name, (_, symbols) in ALPHABETS.items()) + " END"


def _tested_sql() -> str:
    """Per match m: struct(enc, len, p); enc null where no encoding fits."""
    bare = "rtrim('=', m)"
    inner = _bound(
        "enc",
        _encoding_sql("k"),
        f"named_struct('enc', enc, 'len', least(CAST(floor(log2(length(k))) AS INT), {LONGEST_CLASS}), 'p', IF(enc IS NULL, CAST(NULL AS DOUBLE), "
        + _bound("abc", _alphabet_sql("enc"), battery_sql("k", "abc"))
        + "))",
    )
    return _bound("k", bare, inner)


def _joined(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, y -> concat({names}[y.kind], ':', y.s, ':', y.e)), ',')"


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `_base` (sorted base spans) and `_tokens` (tested tokens that no base span overlaps)."""
    by_place = "(l, r) -> CASE WHEN l.s <> r.s THEN l.s - r.s ELSE l.kind - r.kind END"
    bare = f"CAST({{}} AS array<{SPAN}>)"
    return (
        docs.withColumn("_text", text_or_empty(text))
        .withColumn("_assign", located("_text", ASSIGN, 0, f"named_struct('v', length(regexp_extract(m, {_literal(ASSIGN)}, 2)))"))
        .withColumn("_access", located("_text", ACCESS, 1))
        .withColumn("_hex", located("_text", HEX, 2))
        .withColumn(
            "_base",
            F.expr(
                "array_sort(concat("
                f"transform(filter(_assign, y -> y.x.v >= {ASSIGN_LEAST}), y -> named_struct('kind', y.kind, 's', y.s, 'e', y.e)),"
                " transform(_access, y -> named_struct('kind', y.kind, 's', y.s, 'e', y.e)),"
                f" transform(_hex, y -> named_struct('kind', y.kind, 's', y.s, 'e', y.e))), {by_place})"
            ),
        )
        .withColumn("_found", located("_text", TOKEN, 3, "named_struct('m', m)"))
        .withColumn(
            "_tokens",
            F.expr(
                "transform(filter(_found, y -> NOT exists(_base, b -> b.s < y.e AND y.s < b.e)),"
                f" y -> transform(array(y.x.m), m -> named_struct('kind', y.kind, 's', y.s, 'e', y.e, 't', {_tested_sql()}))[0])"
            ),
        )
    )


def thresholds(tested: DataFrame, alpha: float = ALPHA) -> dict[tuple[str, int], float]:
    """Least p-value to report, by (encoding, length class), from counts over the whole table.

    The histogram has at most encodings x length classes x BINS rows.
    """
    token = tested.select(F.explode("_tokens.t").alias("t")).filter("t.p IS NOT NULL")
    counts = token.groupBy(F.col("t.enc").alias("enc"), F.col("t.len").alias("len"), F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).count()
    table_: dict[tuple[str, int], list[int]] = {}
    for r in counts.collect():
        table_.setdefault((r.enc, r.len), [0] * BINS)[r.bin] = r["count"]
    return {c: t for c, h in table_.items() if (t := least_threshold(h, alpha)) is not None}


def least_threshold(histogram: list[int], alpha: float) -> float | None:
    bins = len(histogram)
    random = 2 * sum(histogram[bins // 2 :])
    for k in range(bins):
        kept = sum(histogram[k:])
        if kept and max(0.0, kept - random * (1 - k / bins)) <= alpha * kept:
            return k / bins
    return None


def find_secrets(docs: DataFrame, text: str = "text", alpha: float = ALPHA) -> DataFrame:
    """docs with n_assign, n_access, n_hex, n_random (long), base (string), spans (string).

    Spans are kind:start:end in code points, end exclusive, by start and then kind. A null text
    counts as empty: no spans. Rows are independent but for the counts behind the thresholds, so
    repeated rows get equal results; an empty table gives an empty result. Columns of docs with the
    names of results are replaced.
    """
    own = ["n_assign", "n_access", "n_hex", "n_random", "base", "spans"]
    kept = [c for c in docs.columns if c not in own]
    # every column of docs in one, so that no name of its own can clash
    tested = scanned(docs.select(F.struct(*docs.columns).alias("doc"), F.col(text).alias("text")), "text")
    limits = thresholds(tested.select("_tokens"), alpha)
    cases = " ".join(f"WHEN y.t.enc = '{enc}' AND y.t.len = {n} THEN y.t.p >= {t}D" for (enc, n), t in sorted(limits.items()))
    reported = f"filter(_tokens, y -> CASE {cases} ELSE false END)" if cases else "filter(_tokens, y -> false)"
    by_place = "(l, r) -> CASE WHEN l.s <> r.s THEN l.s - r.s ELSE l.kind - r.kind END"
    out = tested.withColumn("_random", F.expr(f"transform({reported}, y -> named_struct('kind', y.kind, 's', y.s, 'e', y.e))"))
    count = lambda k: F.expr(f"CAST(size(filter(_base, y -> y.kind = {k})) AS BIGINT)")
    return out.select(
        *[F.col(f"doc.`{c}`").alias(c) for c in kept],
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.expr("CAST(size(_random) AS BIGINT)").alias("n_random"),
        F.expr(_joined("_base")).alias("base"),
        F.expr(_joined(f"array_sort(concat(_base, _random), {by_place})")).alias("spans"),
    )


def op5_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_random")
