"""Language identification with a byte convolutional network.

Text becomes classes of its UTF-8 bytes (capitals folded, digits and
punctuation merged) and is cut into windows of fixed length, the last one
padded, so that a whole text is read however long it is. Filters of several
widths slide over a window, the largest response of each filter is kept, and a
softmax over these gives the languages. A text's probabilities are the mean of
its windows', weighted by their bytes.

Training: mini-batches of windows, cross entropy, Adam, in numpy. It sees a
sample of at most ``DOCS_PER_LANGUAGE`` labelled documents a language, chosen by
a hash of the id, and ``WINDOWS_PER_DOC`` windows spread evenly over each. The
network has a few thousand numbers; only these go to the executors, where a
filter response is a sum of table entries per pair of classes.

Cases: null texts and texts without a letter are ``und`` with score 0; rows
without a label are never learned from; ties go to the language that sorts
first. Without any labelled text everything is ``und``. Null and repeated ids are
rows like any other. Only text, and for training id and label, are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.columns import field
from tallyglass.llm.common import by_bytes, without

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
DOCS_PER_LANGUAGE = 600
MOST_DOCS = 120_000
WINDOWS_PER_DOC = 3
EPOCHS = 8
MINI_BATCH = 64
WINDOWS_AT_ONCE = 32
LEAST_SCORE = 0.3


def _byte_classes() -> np.ndarray:
    """0 is padding, 1 everything that is no letter, then letters and bytes of
    multi-byte characters."""
    classes = np.ones(256, dtype=np.int64)
    for i in range(26):
        classes[ord("a") + i] = classes[ord("A") + i] = 2 + i
    classes[ord("'")] = 28
    classes[128:] = 29 + np.arange(128) % 64  # continuation bytes, then lead bytes
    classes[192:] = 93 + np.arange(64) // 4
    # Second bytes of capitals in the Latin-1 block fall on those of their small letters.
    classes[0x80:0x9F] = classes[0xA0:0xBF]
    return classes


BYTE_CLASSES = _byte_classes()
CLASSES = int(BYTE_CLASSES.max()) + 1
_BYTE_TO_CLASS = bytes(BYTE_CLASSES.astype(np.uint8))


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text as classes, one row each."""
    classes = np.frombuffer(text.translate(_BYTE_TO_CLASS), dtype=np.uint8)
    padded = np.zeros(-(-len(classes) // WINDOW) * WINDOW, dtype=np.uint8)
    padded[: len(classes)] = classes
    return padded.reshape(-1, WINDOW)


@dataclass
class Network:
    """``filters[i]`` has shape (width, classes, filters)."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def pair_tables(self) -> list[list[np.ndarray]]:
        """Per width, the tables to add up: over pairs of neighbours, then over
        a last single class for odd widths."""
        tables = []
        for w in self.filters:
            parts = [
                (w[k][:, None, :] + w[k + 1][None, :, :]).reshape(-1, w.shape[2])
                for k in range(0, len(w) - 1, 2)
            ]
            tables.append(parts + ([w[-1]] if len(w) % 2 else []))
        return [[np.ascontiguousarray(t, dtype=np.float32) for t in parts] for parts in tables]

    def probabilities(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        found = []
        for start in range(0, len(windows), WINDOWS_AT_ONCE):
            found.append(_softmax(self._pooled(windows[start : start + WINDOWS_AT_ONCE], tables)[0] @ self.weights + self.offset))
        return np.concatenate(found)

    def _pooled(self, windows: np.ndarray, tables: list[list[np.ndarray]], places: bool = False):
        single = windows.astype(np.int32)
        pairs = single[:, :-1] * CLASSES + single[:, 1:]
        best, at = [], []
        for w, parts in zip(self.filters, tables):
            length = WINDOW - len(w) + 1
            total = None
            for i, table in enumerate(parts):
                index = pairs if len(table) > CLASSES else single
                part = table.take(index[:, 2 * i : 2 * i + length], axis=0, mode="clip")
                total = part if total is None else np.add(total, part, out=total)
            if places:
                at.append(total.argmax(axis=1))
            best.append(total.max(axis=1))
        pooled = np.concatenate(best, axis=1) + self.bias
        return np.maximum(pooled, 0), at


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class _Adam:
    def __init__(self, rate: float = 0.01):
        self.rate, self.step, self.moments = rate, 0, {}

    def update(self, values: list[np.ndarray], gradients: list[np.ndarray]) -> None:
        self.step += 1
        for i, (value, g) in enumerate(zip(values, gradients)):
            m, v = self.moments.setdefault(i, (np.zeros_like(value), np.zeros_like(value)))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
            value -= scale * m / (np.sqrt(v) + 1e-8)


def train(windows: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Fit to windows of classes and the label of each; without any, a network
    that knows no language."""
    languages = sorted(set(labels))
    number = {x: i for i, x in enumerate(languages)}
    target = np.array([number[x] for x in labels], dtype=np.int64)
    random = np.random.default_rng(seed)
    shape = lambda w: (w, CLASSES, FILTERS)
    total = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        [random.normal(0, 0.3, shape(w)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32),
        random.normal(0, 0.1, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    values, adam = [*net.filters, net.bias, net.weights, net.offset], _Adam()
    # A rare language weighs as much as a common one.
    if not languages:
        return net
    share = 1 / np.bincount(target, minlength=len(languages))
    weight = (share / (share[target].mean()))[target].astype(np.float32)
    for _ in range(epochs):
        order = random.permutation(len(windows))
        for start in range(0, len(order), MINI_BATCH):
            rows = order[start : start + MINI_BATCH]
            adam.update(values, _gradients(net, windows[rows], target[rows], weight[rows]))
    return net


def _gradients(net: Network, windows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list:
    n = len(windows)
    pooled, at = net._pooled(windows, net.pair_tables(), places=True)
    error = _softmax(pooled @ net.weights + net.offset)
    error[np.arange(n), target] -= 1
    error *= weight[:, None] / n
    back = (error @ net.weights.T) * (pooled > 0)
    filters = []
    for i, w in enumerate(net.filters):
        part = back[:, i * FILTERS : (i + 1) * FILTERS]
        g = np.zeros_like(w)
        for k in range(len(w)):
            seen = np.take_along_axis(windows, at[i] + k, axis=1)
            np.add.at(g[k], (seen, np.arange(FILTERS)[None, :]), part)
        filters.append(g)
    return [*filters, back.sum(axis=0), pooled.T @ error, error.sum(axis=0)]


# ---------------------------------------------------------------------- Spark


def held_out(id_column: str) -> F.Column:
    """Rows that training never sees: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(field(id_column).cast("string")) % 3 == 1, F.lit(False))


def training_sample(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    most_docs: int = MOST_DOCS,
) -> tuple[np.ndarray, list[str]]:
    """Windows and labels. Every label is learned, however rare. The driver receives at most
    ``docs_per_language`` documents of each and about ``most_docs`` of all together (one of
    each if there are more labels), ``WINDOWS_PER_DOC`` windows of a document, cut out by
    the executors.

    Every language is thinned by a hash of the id to about twice the documents
    wanted before the first of them are ranked, so that the shuffle stays as small
    as the sample however many documents there are."""
    docs = docs.select(*{id_column, text_column, label_column})
    usable = docs.filter(
        field(label_column).isNotNull() & (F.octet_length(field(text_column)) > 0) & ~held_out(id_column)
    ).withColumn("label", field(label_column).cast("string"))
    counts = usable.groupBy("label").count().orderBy(F.desc("count"), "label").collect()
    if not counts:
        return np.zeros((0, WINDOW), np.uint8), []
    docs_per_language = max(1, min(docs_per_language, most_docs // len(counts)))
    hashed = F.xxhash64(field(id_column).cast("string"), field(text_column))
    shares = {row.label: min(1.0, 2 * docs_per_language / row["count"] + 1e-6) for row in counts}
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("label")]
    cuts = ", ".join(
        f"substring(bytes, 1 + CAST(greatest(0, octet_length(bytes) - {WINDOW}) * {i}L / {max(1, WINDOWS_PER_DOC - 1)} AS INT), {WINDOW})"
        for i in range(WINDOWS_PER_DOC)
    )
    thinned = usable.withColumn("place", hashed).filter(F.pmod(hashed, F.lit(1 << 30)) < share * (1 << 30))
    cut = thinned.select(
        "label", "place", F.encode(field(text_column).cast("string"), "UTF-8").alias("bytes")
    ).selectExpr("label", "place", f"array({cuts}) AS cuts")
    of_label = Window.partitionBy("label").orderBy("place")
    chosen = cut.withColumn("rank", F.row_number().over(of_label)).filter(F.col("rank") <= docs_per_language)
    windows, labels = [], []
    for row in sorted(chosen.collect(), key=lambda r: (r.label, r.place)):
        for piece in row.cuts:
            windows.append(windows_of(bytes(piece))[:1])
            labels.append(row.label)
    return np.concatenate(windows), labels


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(texts: list[str | None], net: Network, tables: list) -> tuple[list[str], list[float]]:
    languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    kept = [i for i, t in enumerate(texts) if t and has_letter(t)] if net.languages else []
    if kept:
        encoded = [texts[i].encode() for i in kept]
        windows = [windows_of(t) for t in encoded]
        counts = np.array([len(w) for w in windows])
        probabilities = net.probabilities(np.concatenate(windows), tables)
        # Every window counts by its bytes.
        ends = np.cumsum(counts)
        share = np.full(ends[-1], WINDOW, dtype=np.float64)
        share[ends - 1] = [len(t) - WINDOW * (n - 1) for t, n in zip(encoded, counts)]
        sums = np.add.reduceat(probabilities * share[:, None], ends - counts, axis=0)
        means = sums / np.array([len(t) for t in encoded])[:, None]
        for i, row in zip(kept, means):
            best = int(row.argmax())
            languages[i], scores[i] = net.languages[best], min(1.0, float(row[best]))
    return languages, scores


def identify(docs: DataFrame, net: Network, text_column: str = "text") -> DataFrame:
    """``docs`` and the columns lang_pred and score, which replace any of that name."""
    docs = without(docs, "lang_pred", "score")
    columns = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value.pair_tables()
        for batch in batches:
            for part in by_bytes(batch, text_column, limit=1 << 20):
                languages, scores = predict(part.column(text_column).to_pylist(), sent.value, tables)
                arrays = [*part.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
                yield pa.record_batch(arrays, [*columns, "lang_pred", "score"])

    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return docs.mapInArrow(classify, schema)


def with_language(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang"
) -> DataFrame:
    """Train on the labelled documents that are not held out, then identify all.
    Runs jobs."""
    windows, labels = training_sample(docs, id_column, text_column, label_column)
    return identify(docs, train(windows, labels), text_column)


def identified(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """The rows of ``docs`` that have a language: not ``und``, and a score that is
    not close to guessing. Runs jobs."""
    found = with_language(docs, id_column, text_column, label_column)
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
    return kept.select(*map(field, docs.columns))


def crc_of_id(doc_id: int) -> int:
    """What ``held_out`` computes, for tests."""
    return zlib.crc32(str(doc_id).encode())
