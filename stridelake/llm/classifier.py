"""Quality classifier: a byte-level convolutional network in numpy.

Filters of four bytes run over the whole text with stride two.  The text is seen
in overlapping chunks of 512 bytes (a chunk begins every 384); each chunk is max-pooled
per filter and rectified.  The document's greatest and mean chunk values
are combined into one probability by a logistic layer.  A one-hot byte
convolution is a table look-up, so scoring is two look-ups in a table over byte
pairs per place.

Training (Adam, hinge-free log loss with balanced classes, all in numpy on the
driver) uses a bounded, documented sample: at most ``SAMPLE`` labelled rows of each
class, the ones with the least hash of their id, and none of over ``LONGEST`` bytes;
so what the driver holds has a bound in bytes.  Scoring covers every whole text, in
tasks.

Defined results: null and empty texts get the score of a text without bytes;
null ids are not held out; equal texts get equal scores; labels without a
document, and null labels, are not learned from; of rows with one id each is scored,
and those with a label count towards the sample's bound one by one; without labelled
rows of both classes every score is the untrained network's; an empty table gives no
rows; only ids, texts and labels are read, so other columns, whatever their names, do
not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.base import table, text_slices

FILTERS, WIDTH, STRIDE = 16, 4, 2
#: In places (of two bytes): a block, and the blocks of a chunk and between chunks.
BLOCK, CHUNK_BLOCKS, STEP_BLOCKS = 64, 4, 3
#: Rows of each class that training sees at most, and bytes of a text that it learns from.
SAMPLE, LONGEST = 1_500, 1 << 20
EPOCHS, BATCH, RATE = 8, 32, 0.02
THRESHOLD = 0.3
_NONE = np.float32(-1e9)


class ByteNet:
    """Weights: table (4, 256, filters), bias (filters), out (2 x filters), out_bias."""

    def __init__(self, filters: int = FILTERS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.4, (WIDTH, 256, filters)).astype(np.float32)
        self.bias = np.zeros(filters, np.float32)
        self.out = rng.normal(0, 0.1, 2 * filters).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)
        self._pairs = None

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.out, self.out_bias]

    def prepare(self) -> None:
        """Tables over byte pairs: the first two and the last two places of a filter."""
        two = lambda a, b: (self.table[a][None, :, :] + self.table[b][:, None, :]).reshape(65536, -1)  # noqa: E731  little-endian: low byte first
        self._pairs = two(0, 1), two(2, 3)

    def chunks(self, text: bytes, with_places: bool = False):
        """Max-pooled filter values of each chunk, (chunks, filters); and the places of the maxima."""
        pairs = np.frombuffer(text + b"\0" * (-len(text) % 2 + 2), "<u2")  # zero bytes close the text
        first, second = self._pairs
        n = len(pairs) - 1 if len(text) else 0
        filters = len(self.bias)
        if not n:
            return np.empty((0, filters), np.float32), np.empty((0, filters), np.int64)
        blocks = -(-n // BLOCK)
        top = np.empty((blocks, filters), np.float32)
        at = np.empty((blocks, filters), np.int64) if with_places else None
        for a in range(0, n, BLOCK * 256):  # bounded memory for long texts
            values = first[pairs[a : min(n, a + BLOCK * 256)]] + second[pairs[a + 1 : min(n, a + BLOCK * 256) + 1]]
            if len(values) % BLOCK:
                values = np.concatenate([values, np.full((-len(values) % BLOCK, filters), _NONE)])
            values = values.reshape(-1, BLOCK, filters)
            here = slice(a // BLOCK, a // BLOCK + len(values))
            top[here] = values.max(axis=1)
            if with_places:
                at[here] = values.argmax(axis=1) + (np.arange(len(values)) * BLOCK + a)[:, None]
        starts = range(0, max(1, blocks - CHUNK_BLOCKS + STEP_BLOCKS), STEP_BLOCKS)
        if not with_places:
            return np.stack([top[s : s + CHUNK_BLOCKS].max(axis=0) for s in starts]), None
        which = np.stack([top[s : s + CHUNK_BLOCKS].argmax(axis=0) + s for s in starts])
        columns = np.arange(filters)
        return top[which, columns], at[which, columns]

    def features(self, text: bytes) -> np.ndarray:
        values, _ = self.chunks(text)
        if not len(values):
            return np.zeros(len(self.out), np.float32)
        lit = np.maximum(values + self.bias, 0)
        return np.concatenate([lit.max(axis=0), lit.mean(axis=0)])

    def score(self, text: bytes) -> float:
        z = float(self.features(text) @ self.out + self.out_bias[0])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def gradients(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        filters = len(self.bias)
        grads = [np.zeros_like(w) for w in self.weights()]
        columns = np.arange(filters)
        for text, label, weight in zip(texts, labels, weights):
            values, places = self.chunks(text, with_places=True)
            lit = np.maximum(values + self.bias, 0)
            k = len(lit)
            parts = np.concatenate([lit.max(axis=0), lit.mean(axis=0)]) if k else np.zeros(2 * filters, np.float32)
            z = float(parts @ self.out + self.out_bias[0])
            slope = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
            grads[2] += slope * parts
            grads[3] += slope
            if not k:
                continue
            back = np.repeat(self.out[None, filters:] / k, k, axis=0)
            back[lit.argmax(axis=0), columns] += self.out[:filters]
            back = slope * back * (lit > 0)
            grads[1] += back.sum(axis=0)
            padded = np.frombuffer(text + b"\0" * 4, np.uint8)
            for i in range(WIDTH):
                np.add.at(grads[0][i], (padded[places * STRIDE + i], np.broadcast_to(columns, places.shape)), back)
        return [g / max(1e-9, weights.sum()) for g in grads]


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, filters: int = FILTERS, seed: int = 7) -> ByteNet:
    net = ByteNet(filters, seed)
    labels = np.asarray(labels, float)
    if len(labels) and 0 < labels.mean() < 1:
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        rng = np.random.default_rng(seed)
        moment, square = [np.zeros_like(w) for w in net.weights()], [np.zeros_like(w) for w in net.weights()]
        steps, total = 0, epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), batch):
                part = order[a : a + batch]
                net.prepare()
                steps += 1
                now = rate * (1 - steps / (total + 1))
                for w, g, m, s in zip(net.weights(), net.gradients([texts[i] for i in part], labels[part], weight[part]), moment, square):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= (now * (m / (1 - 0.9**steps)) / (np.sqrt(s / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    net.prepare()
    return net


def held_out(id_col: Column) -> Column:
    """Every fifth id by checksum; never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, sample: int = SAMPLE) -> list:
    """(text, label) of at most ``sample`` rows of each class, by least hash of the id; texts over ``LONGEST`` bytes are not learned from.

    Both bounds hold after the join, so repeated ids or label rows do not multiply them."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).select("doc_id", F.col(label_col).alias("label"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = [usable.where(F.col("label") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    chosen = F.broadcast(chosen[0].union(chosen[1]))  # 2 x sample rows at most
    both = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id").where(F.octet_length("text") <= LONGEST)
    taken = [both.where(F.col("label") == k).orderBy(*order, F.xxhash64("text")).limit(sample) for k in (0, 1)]
    return taken[0].union(taken[1]).orderBy("doc_id", "label").collect()


def _scored(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = ByteNet()
        net.table, net.bias, net.out, net.out_bias = weights.value
        net.prepare()
        for part, texts in text_slices(batches, "__text"):
            kept = [i for i, name in enumerate(part.schema.names) if name != "__text"]
            scores = pa.array([net.score(t or b"") for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), scores], [*(part.schema.names[i] for i in kept), "score"])

    return run


def score_documents(docs: DataFrame, net: ByteNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the score of every row."""
    weights = docs.sparkSession.sparkContext.broadcast(net.weights())
    rows = docs.select(id_col, F.col(text_col).alias("__text"))
    return rows.mapInArrow(_scored(weights), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double")


def op5_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = training_rows(docs, table(spark, sf_dir, "labels"), "quality")
    net = train([r["text"].encode() for r in rows], np.array([r["label"] for r in rows]))
    scored = score_documents(docs, net)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
