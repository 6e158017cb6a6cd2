"""Personal data: fixed patterns plus information-theoretic sanitisation.

Base kinds (email, ip, card, phone) are found by pattern; each value is a protected entity. A term
(word) that occurs in a document beside an entity may reveal it even when the entity itself is
masked. Over the whole corpus, df(t) is the number of documents with term t, df(e) that with entity
e, and n(t, e) that with both. The disclosure of e by t is the pointwise mutual
information log2(n(t,e) N / (df(t) df(e))), normalised by -log2(n(t,e) / N), at most 1. Terms seen
with e in at least SUPPORT documents with a normalised value over GENERALISE are generalised (to
their shape class), over REMOVE removed. Every occurrence in documents that hold the
entity is masked; other documents, so all without personal data, stay as they are. Since n(t, e) is
at most df(e), only entities of SUPPORT documents are paired with terms.

df(t) is needed for terms beside such entities only. A bitmap of fixed size (BITS bits, whatever the
input) with their hashes is broadcast, and every document's words are held against it; false hits
fall out in the join, so counts are exact.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import arrow_bounded, fresh, numbered, table, written

KINDS = ("email", "ip", "card", "phone", "term")
#: The base patterns. The address part of an email is found from its @ sign, see emails().
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\W\d_]{2,}")

SUPPORT = 2
GENERALISE = 0.8
REMOVE = 0.95
BITS = 1 << 24


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local@domain, in time linear in the text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """A run of digits that no second part follows is left behind whole: its tails fail as well."""
    out, at = [], 0
    while m := DIGIT.search(text, at):
        end = m.end()
        while end < len(text) and "0" <= text[end] <= "9":
            end += 1
        if text[end : end + 1] == "." and (hit := IP.match(text, m.start())):
            at = hit.end()
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in hit[0].split(".")):
                out.append(hit.span())
        else:
            at = end
    return out


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m[0])) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind as listed."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            out += [(s, 1, e) for s, e in ips(text)]
        out += [(s, 2, e) for s, e in cards(text)]
        if "+" in text:
            out += [(s, 3, e) for s, e in phones(text)]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def entity(kind: int, value: str) -> str:
    """The protected value, written the same way wherever it occurs."""
    value = value.lower() if kind < 2 else "".join(c for c in value if c.isdigit())
    return f"{KINDS[kind]}:{value}"


def words_of(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of each word that no span overlaps."""
    out, ends, i, last = [], sorted((s, e) for s, _, e in spans), 0, 0
    for m in WORD.finditer(text):
        while i < len(ends) and ends[i][0] < m.end():
            last = max(last, ends[i][1])
            i += 1
        if last <= m.start():
            out.append((m[0].lower(), m.start(), m.end()))
    return out


def near_terms(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) for every entity and word of the text."""
    names = sorted({entity(k, text[s:e]) for s, k, e in spans})
    return [(name, *word) for name in names for word in words_of(text, spans)]


FOUND = "row long, base string, n_email long, n_ip long, n_card long, n_phone long, entities array<string>, words array<struct<term:string,s:int,e:int>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In slices, so that the words of large documents stay small in memory."""
    kind = pa.list_(pa.struct([("term", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))
    for batch in (b.slice(i, 256) for b in batches for i in range(0, len(b), 256)):
        base, names, words, counts = [], [], [], []
        for cell in batch.column(1):
            text = cell.as_py() or ""
            spans = base_spans(text)
            base.append(joined(spans))
            counts.append(Counter(k for _, k, _ in spans))
            names.append(sorted({entity(k, text[s:e]) for s, k, e in spans}) if spans else None)
            words.append([dict(zip(("term", "s", "e"), x)) for x in words_of(text, spans)] if spans else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(base, pa.string()), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(4)], pa.array(names, pa.list_(pa.string())), pa.array(words, kind)],
            names=["row", "base", "n_email", "n_ip", "n_card", "n_phone", "entities", "words"],
        )


def _place(term: str) -> int:
    return zlib.crc32(term.encode()) & (BITS - 1)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial bitmap a task, as its non-zero pieces of 4 KB."""
    bitmap = np.zeros(BITS // 8, np.uint8)
    for batch in batches:
        for term in batch.column(0):
            at = _place(term.as_py())
            bitmap[at >> 3] |= 1 << (at & 7)
    pieces = bitmap.reshape(-1, 4096)
    used = np.flatnonzero(pieces.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([pieces[i].tobytes() for i in used], pa.binary())], names=["piece", "bits"])


def _or(pieces: DataFrame) -> np.ndarray:
    """The union, at most BITS / 8 bytes, on the driver."""

    def union(key, rows):
        total = np.bitwise_or.reduce([np.frombuffer(b.as_py(), np.uint8) for b in rows.column("bits")])
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([total.tobytes()], pa.binary())})

    bitmap = np.zeros(BITS // 8, np.uint8).reshape(-1, 4096)
    for r in pieces.groupBy("piece").applyInArrow(union, "piece int, bits binary").collect():
        bitmap[r.piece] = np.frombuffer(r.bits, np.uint8)
    return bitmap.ravel()


def document_frequencies(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """(term, df): in how many rows of docs each term of terms(term) occurs."""
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(_or(terms.mapInArrow(_bits, "piece int, bits binary")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, known, seen = bitmap.value, {}, Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "df"])
            seen.clear()
            return out

        for batch in batches:
            for cell in batch.column(0):
                for word in set(WORD.findall((cell.as_py() or "").lower())):
                    hit = known.get(word)
                    if hit is None:
                        if len(known) > 500_000:
                            known.clear()
                        at = _place(word)
                        hit = known[word] = bool(wanted[at >> 3] >> (at & 7) & 1)
                    if hit:
                        seen[word] += 1
            if len(seen) > 200_000:
                yield flush()
        yield flush()

    partial = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "term string, df long")
    return partial.groupBy("term").agg(F.sum("df").alias("df")).join(terms, "term", "left_semi")


def disclosures(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(entity, term, npmi) over GENERALISE, from counts over all rows of docs."""
    rows_of = found.select("row", F.explode("entities").alias("entity"))
    df_e = rows_of.groupBy("entity").agg(F.count("*").alias("df_e")).filter(F.col("df_e") >= SUPPORT)
    held = rows_of.join(df_e, "entity", "left_semi").groupBy("row").agg(F.collect_list("entity").alias("held"))
    once = found.join(held, "row").select("held", F.explode(F.array_distinct(F.col("words.term"))).alias("term"))
    both = once.select(F.explode("held").alias("entity"), "term").groupBy("entity", "term").agg(F.count("*").alias("n_te"))
    n = F.lit(float(docs.count()))

    def npmi(df_t: str):
        pmi = F.log2(F.col("n_te") * n / (F.col(df_t) * F.col("df_e")))
        return F.when(F.col("n_te") >= n, F.lit(0.0)).otherwise(pmi / -F.log2(F.col("n_te") / n))

    # a term is in at least as many rows as hold it beside some entity; with that alone most pairs are out
    beside = once.groupBy("term").agg(F.count("*").alias("least_df"))
    often = both.filter(F.col("n_te") >= SUPPORT).join(df_e, "entity").join(beside.hint("merge"), "term")
    often = written(often.filter(npmi("least_df") > GENERALISE - 1e-9).select("entity", "term", "n_te", "df_e"))
    df_t = document_frequencies(docs, often.select("term").distinct(), text).withColumnRenamed("df", "df_t")
    return often.join(df_t, "term").select("entity", "term", npmi("df_t").alias("npmi")).filter(F.col("npmi") > GENERALISE)


def sanitised_spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(docs with a number of each row in `_row`, or a name like it that docs does not have; spans by `_row`).

    spans: _row, n_email, n_ip, n_card, n_phone, base (base spans joined), terms: array of
    struct(s, e, removed). A null text counts as empty. Every row is on its own: rows with repeated
    or null keys keep theirs apart.
    """
    arrow_bounded(docs.sparkSession)
    row = fresh("_row", docs)
    rows = numbered(docs, row)
    found = written(rows.select(row, F.col(text).cast("string").alias("text")).mapInArrow(_find, FOUND))
    told = disclosures(found, docs, text)
    rows_of = found.select("row", F.explode("entities").alias("entity"))
    telling = rows_of.join(told, "entity").groupBy("row", "term").agg((F.max("npmi") > REMOVE).alias("removed"))
    places = found.join(telling.select("row").distinct(), "row", "left_semi").select("row", F.explode("words").alias("x")).select("row", "x.*")
    hits = places.join(telling, ["row", "term"])
    terms = hits.groupBy(F.col("row").alias("_hit")).agg(F.sort_array(F.collect_list(F.struct("s", "e", "removed"))).alias("terms"))
    spans = found.drop("entities", "words").join(terms, F.col("row") == F.col("_hit"), "left").drop("_hit").withColumnRenamed("row", "_row")
    return rows, spans


def all_spans(base: str, terms) -> list[tuple[int, int, int]]:
    spans = []
    for x in filter(None, base.split(",")):
        k, s, e = x.split(":")
        spans.append((int(s), KINDS.index(k), int(e)))
    return sorted(spans + [(t["s"], 4, t["e"]) for t in terms or ()])


#: What takes the place of base values; terms are generalised to WORD or removed.
MASKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[WORD]")


def masked(text: str, base: str, terms) -> str:
    """text with its spans replaced. Overlapping base spans are joined and take the first one's mask."""
    gone = {t["s"] for t in terms or () if t["removed"]}
    out, at, last = [], 0, 0
    for s, k, e in all_spans(base, terms):
        if s < last:
            last = max(last, e)
            at = last
            continue
        out.append(text[at:s])
        out.append("" if k == 4 and s in gone else MASKS[k])
        at = last = e
    out.append(text[at:])
    return "".join(out)


TERMS_TYPE = "array<struct<s:int,e:int,removed:boolean>>"


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `text` masked, all other columns and rows as they are. Null texts stay null."""
    rows, spans = sanitised_spans(docs, text)
    row, base, terms = rows.columns[-1], fresh("_base", docs), fresh("_terms", docs)

    @F.arrow_udf("string")
    def mask(texts: pa.Array, bases: pa.Array, found: pa.Array) -> pa.Array:
        cells = zip(texts.to_pylist(), bases.to_pylist(), found.to_pylist())
        return pa.array([masked(t, b, x) if t is not None else None for t, b, x in cells], pa.string())

    # only what has spans reaches Python; the documents are moved once
    touched = spans.filter("base <> ''").select(F.col("_row").alias(row), F.col("base").alias(base), F.col("terms").alias(terms))
    back = rows.join(touched.hint("merge"), row, "left")
    open_ = F.when(F.col(base).isNotNull(), F.col(text))
    return back.select(*[F.coalesce(mask.asNondeterministic()(open_, base, terms), F.col(text)).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns])


def op9_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    numbered_docs, spans = sanitised_spans(docs)
    place = "CASE WHEN l.s <> r.s THEN l.s - r.s ELSE l.k - r.k END"
    base = "transform(filter(split(base, ','), x -> x <> ''), x -> named_struct('k', array_position(kinds, split(x, ':')[0]), 's', CAST(split(x, ':')[1] AS INT), 'x', x))"
    more = "transform(coalesce(terms, array()), t -> named_struct('k', 5L, 's', t.s, 'x', concat('term:', t.s, ':', t.e)))"
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    joined_all = F.expr(
        f"CASE WHEN terms IS NULL THEN base ELSE array_join(transform(array_sort(concat({base.replace('kinds', kinds)}, {more}), (l, r) -> CAST({place} AS INT)), y -> y.x), ',') END"
    )
    found = spans.select("_row", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), joined_all.alias("spans"))
    return numbered_docs.select("doc_id", "_row").join(found, "_row").drop("_row")


def digest(text: str) -> str:
    return hashlib.sha256(joined(base_spans(text)).encode()).hexdigest()
