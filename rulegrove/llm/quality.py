"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE bytes. Every passage of every whole text is encoded
(byte-class shares, hashed byte-class bigrams, word-shape and repetition figures), projected through
a learned layer, and weighed by gated attention (Ilse et al., 2018): a_i ~ exp(w . (tanh(V h_i) *
sigmoid(U h_i))). The weighted sum of passages is scored by a logistic unit. Encoder, attention and
scorer are learned together from document labels alone, on at most TRAIN_ROWS whole labelled
documents of at most TRAIN_PASSAGES passages in all, chosen by a hash of their key; the model has a
fixed size. Scoring covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import arrow_bounded, crc_text, table

PASSAGE = 512
#: Bound of the labelled sample that the model is fitted on.
TRAIN_ROWS = 4000
#: Bound of its passages in all; documents are taken whole or not at all.
TRAIN_PASSAGES = 40_000
FOLDS = 5
THRESHOLD = 0.3
BIGRAMS = 256
BYTES_PER_BATCH = 500_000


def _classes() -> np.ndarray:
    """Byte -> one of 16 classes: letters by case and vowel, digits, blanks, kinds of punctuation, high bytes."""
    out = np.full(256, 15, np.uint8)
    for c in range(256):
        ch = chr(c)
        if ch in "aeiou":
            out[c] = 0
        elif "a" <= ch <= "z":
            out[c] = 1
        elif ch in "AEIOU":
            out[c] = 2
        elif "A" <= ch <= "Z":
            out[c] = 3
        elif "0" <= ch <= "9":
            out[c] = 4
        elif ch == " ":
            out[c] = 5
        elif ch in "\n\r\t\v\f":
            out[c] = 6
        elif ch in ".,":
            out[c] = 7
        elif ch in "!?":
            out[c] = 8
        elif ch in "'\"()-;:":
            out[c] = 9
        elif ch in "|/\\_=<>[]{}":
            out[c] = 10
        elif ch in "#$%&*@+~^`":
            out[c] = 11
        elif c < 128:
            out[c] = 12
        elif c < 192:
            out[c] = 13
        elif c < 224:
            out[c] = 14
    return out


CLASS = _classes()
LAGS = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 24)
FEATURES = BIGRAMS + len(LAGS) + 6


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, document of each). An empty text is one passage of zeros."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    doc = np.repeat(np.arange(len(texts)), counts)
    total = int(counts.sum())
    data = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum(counts) - counts
    starts = np.cumsum(sizes) - sizes
    # passage of each byte
    where = np.repeat(first, sizes) + (np.arange(len(data)) - np.repeat(starts, sizes)) // PASSAGE
    where = where.astype(np.int32)
    kind = CLASS[data]
    length = np.maximum(1, np.bincount(where, minlength=total)).astype(np.float64)
    out = np.zeros((total, FEATURES), np.float32)
    if len(data) > 1:
        inside = where[1:] == where[:-1]
        pair = kind[:-1].astype(np.int32) * 16 + kind[1:]
        both = np.bincount((where[:-1] * BIGRAMS + pair)[inside], minlength=total * BIGRAMS)
        out[:, :BIGRAMS] = np.sqrt(both.reshape(total, BIGRAMS) / length[:, None])
        # repetition: the share of words equal to the one `lag` words earlier
        blank = (kind == 5) | (kind == 6)
        fresh = np.r_[True, blank[:-1]]
        fresh[starts[sizes > 0]] = True
        begins = np.flatnonzero(fresh & ~blank)
        stops = starts + sizes
        ends = np.minimum(np.r_[begins[1:], len(data)], stops[np.searchsorted(stops, begins, side="right")])
        # a word's signature: sum of mixed bytes and its length, enough to see repeats
        flat = np.r_[np.uint64(0), np.cumsum(MIX[data])]
        word = (flat[ends] - flat[begins]) * np.uint64(0x9E3779B97F4A7C15) + (ends - begins).astype(np.uint64)
        home = where[begins]
        words = np.maximum(1, np.bincount(home, minlength=total))
        for i, lag in enumerate(LAGS):
            if len(word) > lag:
                same = (word[lag:] == word[:-lag]) & (home[lag:] == home[:-lag])
                out[:, BIGRAMS + i] = np.bincount(home[lag:][same], minlength=total) / words
        at = BIGRAMS + len(LAGS)
        width = (ends - begins).astype(np.float64)
        mean = np.bincount(home, weights=width, minlength=total) / words
        out[:, at] = mean / 10
        out[:, at + 1] = np.sqrt(np.maximum(0, np.bincount(home, weights=width**2, minlength=total) / words - mean**2)) / 10
        for i, k in enumerate((3, 10, 11)):
            out[:, at + 2 + i] = np.bincount(where[kind == k], minlength=total) / length
    out[:, FEATURES - 1] = np.log1p(length) / 7 * (sizes[doc] > 0)
    return out, doc


_RNG = np.random.default_rng(7)
MIX = _RNG.integers(1, 1 << 62, 256, dtype=np.uint64)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """Encoder, gated attention and scorer as plain arrays."""

    def __init__(self, inputs: int = FEATURES, hidden: int = 24, gate: int = 12, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(inputs), np.ones(inputs)
        self.p = {
            "W": rng.normal(size=(inputs, hidden)) / np.sqrt(inputs),
            "b": np.zeros(hidden),
            "V": rng.normal(size=(hidden, gate)) / np.sqrt(hidden),
            "U": rng.normal(size=(hidden, gate)) / np.sqrt(hidden),
            "w": rng.normal(size=gate) / np.sqrt(gate),
            "c": rng.normal(size=hidden) / np.sqrt(hidden),
            "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, doc: np.ndarray, n: int):
        """doc: bag of each row, ascending, none empty."""
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        starts = np.searchsorted(doc, np.arange(n))
        e = np.exp(e - np.maximum.reduceat(e, starts)[doc])
        a = e / np.add.reduceat(e, starts)[doc]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return h, t, s, a, z, _sigmoid(z @ p["c"] + p["d"]), starts

    def score(self, x: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        return self.forward((x - self.mean) / self.scale, doc, n)[5]

    def fit(self, x: np.ndarray, doc: np.ndarray, y: np.ndarray, epochs: int = 60, rate: float = 0.01, decay: float = 1e-4, bag: int = 256):
        self.mean, self.scale = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64) + 1e-3
        x = (x - self.mean.astype(np.float32)) / self.scale.astype(np.float32)
        n = len(y)
        starts, ends = np.searchsorted(doc, np.arange(n)), np.searchsorted(doc, np.arange(n), side="right")
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        rng, step = np.random.default_rng(13), 0
        for _ in range(epochs):
            order = rng.permutation(n)
            for part in np.array_split(order, max(1, n // bag)):
                rows = np.concatenate([np.arange(starts[i], ends[i]) for i in part])
                own = np.repeat(np.arange(len(part)), ends[part] - starts[part])
                grads = self.gradients(x[rows], own, y[part])
                step += 1
                for k, g in grads.items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def gradients(self, x: np.ndarray, doc: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(y)
        h, t, s, a, z, out, starts = self.forward(x, doc, n)
        d_out = (out - y) / n
        d_z = d_out[:, None] * p["c"]
        d_a = (h * d_z[doc]).sum(axis=1)
        d_e = a * (d_a - np.add.reduceat(a * d_a, starts)[doc])
        d_t = d_e[:, None] * p["w"] * s * (1 - t * t)
        d_s = d_e[:, None] * p["w"] * t * s * (1 - s)
        d_h = a[:, None] * d_z[doc] + d_t @ p["V"].T + d_s @ p["U"].T
        d_x = d_h * (1 - h * h)
        return {
            "W": x.T @ d_x,
            "b": d_x.sum(axis=0),
            "V": h.T @ d_t,
            "U": h.T @ d_s,
            "w": ((t * s) * d_e[:, None]).sum(axis=0),
            "c": z.T @ d_out,
            "d": np.array([d_out.sum()]),
        }


def labelled(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """At most TRAIN_ROWS keys to learn from, outside the held-out fold, chosen by hash; one label each."""
    rows = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & (crc_text(F.col(key)) % FOLDS != 0))
    one = rows.groupBy(F.col(key).alias("_key")).agg(F.min(F.col(label).cast("int")).alias("_label"))
    return one.orderBy(F.xxhash64("_key"), "_key").limit(TRAIN_ROWS)


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _label, _print, _text): whole documents to learn from, equal rows once.

    Rows come in the order of a hash of their key; a row is left out if it would take the sample over
    TRAIN_ROWS rows or TRAIN_PASSAGES passages.
    """
    keys = F.broadcast(labelled(labels, key))  # TRAIN_ROWS rows of two numbers
    own = docs.select(F.col(key).cast("long").alias("_doc"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text"))
    rows = own.join(keys, F.col("_doc") == F.col("_key")).select("_doc", "_label", F.xxhash64("_text").alias("_print"), "_text")
    passages = F.greatest(F.lit(1), F.ceil(F.octet_length("_text") / PASSAGE)).alias("n")
    told = rows.select("_doc", "_label", "_print", passages).distinct().orderBy(F.xxhash64("_doc"), "_doc", "_print").limit(TRAIN_ROWS).collect()
    chosen, left = [], TRAIN_PASSAGES
    for r in told:
        if r.n <= left:
            left -= r.n
            chosen.append((r["_doc"], r["_print"]))
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame(chosen, "_doc long, _print long"))
    return rows.join(wanted, ["_doc", "_print"], "left_semi").groupBy("_doc", "_label", "_print").agg(F.first("_text").alias("_text"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> GatedAttention:
    """Fit on all passages of the sample. Without labels the untrained model is returned."""
    arrow_bounded(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, p, y, cell in zip(*b.columns):
                x, _ = encode([cell.as_py()])
                values = [pa.array([k.as_py()]), pa.array([p.as_py()]), pa.array([y.as_py()], pa.int32()), pa.array([x.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(values, names=["k", "p", "y", "x"])

    rows = sample(docs, labels, key, text).select("_doc", "_print", "_label", "_text")
    got = sorted(rows.mapInArrow(encoded, "k long, p long, y int, x binary").collect(), key=lambda r: (r.k, r.p))  # TRAIN_ROWS rows, TRAIN_PASSAGES passages
    model = GatedAttention()
    if not got:
        return model
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in got]
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return model.fit(np.concatenate(bags), doc, np.array([r.y for r in got], float))


def scored(docs: DataFrame, model: GatedAttention, text: str = "text", into: str = "score") -> DataFrame:
    """docs with the score of every row in a column `into`, which replaces one of that name.

    0 to 1, higher if label 1 is likelier. Null and empty texts get the score of an empty passage.
    Rows are scored one by one, so ties and repeated rows get equal scores and an empty table an
    empty result; other columns and their names do not matter. Only the text goes to Python and only
    the score comes back.
    """
    arrow_bounded(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for texts in batches:
            parts, at = [np.zeros(0)], 0
            while at < len(texts):
                size, part = 0, []
                while at < len(texts) and (size < BYTES_PER_BATCH or not part):
                    part.append(texts[at].as_py() or b"")
                    size += len(part[-1])
                    at += 1
                x, doc = encode(part)
                parts.append(own.score(x, doc, len(part)))
            yield pa.array(np.concatenate(parts), pa.float64())

    return docs.withColumn(into, score.asNondeterministic()(F.col(text).cast("binary")))  # runs once, wherever the score is used


def quality_scores(docs: DataFrame, model: GatedAttention, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep (default: the key) and score of every row of docs, as `scored` gives it."""
    keep = [key] if keep is None else keep
    return scored(docs, model, text).select(*keep, "score")


def predicted(score="score") -> F.Column:
    return (F.col(score) >= THRESHOLD).cast("int")


def op1_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held = (crc_text(F.col("doc_id")) % FOLDS == 0).alias("held_out")
    return quality_scores(docs, model).select("doc_id", held, "score", predicted().alias("predicted"))
