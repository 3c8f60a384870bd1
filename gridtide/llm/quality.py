"""Quality classifier: a convolutional network on bytes, in numpy.

Each byte has a learned vector; learned filters run over windows of bytes with a stride; windows are grouped in chunks that overlap by what a window
reaches over, and cover the whole text; each filter's largest response in a chunk is kept. The mean and the maximum over chunks go into one
logistic unit. Training has two steps, both on at most ``PER_CLASS`` rows of each label, chosen by hash. Vectors and filters are learned by Adam on the
driver, from ``CHUNKS`` chunks of each row, so what is collected is bounded (24 MB with the defaults). The logistic unit is then fitted to the mean and
maximum over all chunks of these rows, which tasks compute as in scoring. Scoring reads every byte of every text, in tasks, a piece at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import release, ship, stage
from gridtide.operators.layout import small_copy

PER_CLASS = 1500
CHUNKS = 16
WIDTH, STRIDE, PER_CHUNK = 12, 2, 252
FILTERS, DEPTH = 32, 4
EPOCHS, BATCH, RATE, DECAY = 14, 64, 0.01, 1e-5
SEED = 7
#: how strongly the second step holds to the first
RIDGE = 1e-3
THRESHOLD = 0.3
#: bytes of a chunk, and from one chunk to the next
CHUNK_BYTES, CHUNK_STEP = (PER_CHUNK - 1) * STRIDE + WIDTH, PER_CHUNK * STRIDE
#: chunks that are scored at a time
PIECE = 64


@dataclass
class Network:
    embedding: np.ndarray  # (256, DEPTH)
    filters: np.ndarray  # (WIDTH * DEPTH, FILTERS)
    shift: np.ndarray  # (FILTERS,)
    combine: np.ndarray  # (2 * FILTERS,)
    bias: float

    def responses(self, chunk: np.ndarray) -> np.ndarray:
        """(windows, FILTERS) of bytes."""
        windows = np.lib.stride_tricks.sliding_window_view(chunk, WIDTH)[::STRIDE]
        return self.embedding[windows].reshape(len(windows), -1) @ self.filters + self.shift

    def pooled(self, data: bytes) -> np.ndarray:
        """(chunks, FILTERS): the largest response in each chunk, at least 0."""
        data, out = padded(data), []
        for at in range(0, max(len(data) - WIDTH, 0) + 1, PIECE * CHUNK_STEP):
            piece = data[at : at + PIECE * CHUNK_STEP + WIDTH - STRIDE]
            if len(piece) < WIDTH:
                break
            responses = self.responses(piece)
            out.append(np.maximum.reduceat(responses, range(0, len(responses), PER_CHUNK), axis=0))
        return np.maximum(np.concatenate(out), 0)

    def features(self, data: bytes) -> np.ndarray:
        pooled = self.pooled(data)
        return np.concatenate([pooled.mean(axis=0), pooled.max(axis=0)])

    def score(self, data: bytes) -> float:
        z = float(self.features(data) @ self.combine + self.bias)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def padded(data: bytes) -> np.ndarray:
    """Bytes with zeros behind, so that the last window ends where the text does or after."""
    short = max(WIDTH - len(data), (WIDTH - len(data)) % STRIDE)
    return np.frombuffer(data + bytes(short), np.uint8)


def chunks(data: bytes) -> list[bytes]:
    """The chunks of a text; together they cover it."""
    whole = padded(data).tobytes()
    return [whole[at : at + CHUNK_BYTES] for at in range(0, max(len(whole) - WIDTH, 0) + 1, CHUNK_STEP)]


def fit(docs: list[list[bytes]], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """A network from the chunks of each document, its labels (0 or 1) and weights."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
        rng.normal(0, 0.3, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        0.0,
    )
    # chunks of one size, to be taken together; the padding's windows count like others'
    length = CHUNK_BYTES
    table = np.zeros((sum(map(len, docs)), length), np.uint8)
    full = np.zeros(len(table), np.int64)
    starts = np.cumsum([0] + [len(d) for d in docs])
    for row, chunk in enumerate(c for d in docs for c in d):
        table[row, : len(chunk)] = np.frombuffer(chunk, np.uint8)
        full[row] = (len(chunk) - WIDTH) // STRIDE + 1
    params = {"embedding": net.embedding, "filters": net.filters, "shift": net.shift, "combine": net.combine, "bias": np.zeros(1, np.float32)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    weights = weights / weights.mean()
    step, windows = 0, np.arange(PER_CHUNK)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            rows = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in chosen])
            sizes = starts[chosen + 1] - starts[chosen]
            begins = np.cumsum(sizes) - sizes
            data = table[rows]
            seen = np.lib.stride_tricks.sliding_window_view(data, WIDTH, axis=1)[:, ::STRIDE]  # chunk, window, byte
            x = params["embedding"][seen].reshape(len(rows), PER_CHUNK, -1)
            r = x @ params["filters"] + params["shift"]
            r[windows[None, :] >= full[rows][:, None]] = -np.inf
            best = r.argmax(axis=1)  # chunk, filter
            top = np.take_along_axis(r, best[:, None, :], axis=1)[:, 0]
            pooled = np.maximum(top, 0)
            mean = np.add.reduceat(pooled, begins, axis=0) / sizes[:, None]
            most = np.maximum.reduceat(pooled, begins, axis=0)
            z = np.concatenate([mean, most], axis=1) @ params["combine"] + params["bias"]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            dz = ((p - labels[chosen]) * weights[chosen] / len(chosen)).astype(np.float32)
            grads = {"combine": np.concatenate([mean, most], axis=1).T @ dz, "bias": np.array([dz.sum()], np.float32)}
            of = np.repeat(np.arange(len(chosen)), sizes)
            dpool = dz[of][:, None] * params["combine"][:FILTERS] / sizes[of][:, None]
            first = (pooled == most[of]) * (dz[of][:, None] * params["combine"][FILTERS:])
            dpool = (dpool + first / np.add.reduceat((pooled == most[of]) * 1.0, begins, axis=0)[of]) * (top > 0)
            chunk, which = np.nonzero(dpool)
            g = dpool[chunk, which].astype(np.float32)
            grads["shift"] = np.bincount(which, g, FILTERS).astype(np.float32)
            spots = x[chunk, best[chunk, which]]  # the windows that won
            grads["filters"] = np.stack([np.bincount(which, g * spots[:, i], FILTERS) for i in range(WIDTH * DEPTH)]).astype(np.float32)
            back = (g[:, None] * params["filters"].T[which]).reshape(-1, DEPTH)
            where = seen[chunk, best[chunk, which]].reshape(-1)
            grads["embedding"] = np.stack([np.bincount(where, back[:, i], 256) for i in range(DEPTH)], axis=1).astype(np.float32)
            step += 1
            for k, grad in grads.items():
                m, v = moments[k]
                grad = grad + DECAY * params[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                params[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(params["embedding"], params["filters"], params["shift"], params["combine"], float(params["bias"][0]))


def refit(net: Network, features: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> Network:
    """The network with a logistic unit fitted to the features of whole texts, by Newton steps from the one it has."""
    x = np.column_stack([features, np.ones(len(features))]).astype(np.float64)
    start = np.append(net.combine, net.bias).astype(np.float64)
    unit, weights = start.copy(), weights / weights.sum()
    scale = np.append((weights @ x[:, :-1] ** 2) + 1e-6, 0.0)

    def loss(u: np.ndarray) -> float:
        z = x @ u
        return float(weights @ (np.logaddexp(0, z) - labels * z) + ridge / 2 * scale @ (u - start) ** 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ unit, -30, 30)))
        slope = x.T @ (weights * (p - labels)) + ridge * scale * (unit - start)
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge * scale + 1e-9)
        step, size, now = np.linalg.solve(bend, slope), 1.0, loss(unit)
        while size > 1e-6 and loss(unit - size * step) > now:
            size /= 2
        if now - loss(unit - size * step) < 1e-9:
            break
        unit = unit - size * step
    return Network(net.embedding, net.filters, net.shift, unit[:-1].astype(np.float32), float(unit[-1]))


def constant(share: float) -> Network:
    """What there is without labels of both kinds: one probability."""
    zero = np.zeros
    return Network(
        zero((256, DEPTH), np.float32), zero((WIDTH * DEPTH, FILTERS), np.float32), zero(FILTERS, np.float32),
        zero(2 * FILTERS, np.float32), float(np.log(share / (1 - share))),
    )


def held_out(id_col: str):
    """Rows whose labels are never learned from: crc32 of the id as text is a multiple of 5. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS
) -> Network:
    """A network from labelled rows that are not held out.

    Of each label, the ``per_class`` rows whose ids have the smallest hashes are used, weighted to the label's share of all labelled rows. A row
    with several labels counts with the largest one; null labels and ids are left out. Without rows of both labels, the smoothed share of
    label 1 is every text's probability. An id may come with any number of texts: of all texts of a label, too, the first ``per_class`` by hash are used.
    """
    ship(docs.sparkSession)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    count = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}
    if len(count) < 2:
        return constant((count.get(1, 0) + 1) / (sum(count.values()) + 2))
    picked = None
    for label in (0, 1):
        part = known.filter(F.col("_label") == label).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("t")).join(
        small_copy(picked, 2 * per_class), F.col("id") == F.col("_id")
    )
    chosen = chosen.select("id", "t", "_label", F.xxhash64("id", "t").alias("_order"))

    def bounded(rows: DataFrame) -> list:
        """Of each label, the first ``per_class`` rows: an id may have many."""
        out = []
        for label in (0, 1):
            part = rows.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id", "place", "value")
            out += part.limit(per_class).collect()
        return out

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            parts = [chunks(t.as_py()) for t in batch.column(1)]
            parts = [[p[i] for i in sorted({len(p) * j // CHUNKS for j in range(CHUNKS)})] for p in parts]
            yield pa.record_batch([*(batch.column(i) for i in (0, 2, 3)), pa.array(parts, pa.list_(pa.binary()))], names)

    names = ["id", "label", "place", "value"]
    kinds = f"id {chosen.schema['id'].dataType.simpleString()}, label int, place long, value "
    rows = bounded(stage(chosen.mapInArrow(cut, kinds + "array<binary>"), "labelled"))
    rows.sort(key=lambda r: (str(r.id), r.value))
    used = np.bincount([r.label for r in rows], minlength=2)
    if not used.all():
        return constant((count.get(1, 0) + 1) / (sum(count.values()) + 2))

    def weighed(rows: list) -> tuple[np.ndarray, np.ndarray]:
        return np.array([r.label for r in rows], np.float32), np.array([count[r.label] / used[r.label] for r in rows])

    net = fit([[bytes(c) for c in r.value] for r in rows], *weighed(rows))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = [shared.value.features(t.as_py()).astype(np.float32).tolist() for t in batch.column(1)]
            yield pa.record_batch([*(batch.column(i) for i in (0, 2, 3)), pa.array(found, pa.list_(pa.float32()))], names)

    rows = bounded(stage(chosen.mapInArrow(whole, kinds + "array<float>"), "labelled-features"))
    rows.sort(key=lambda r: (str(r.id), r.value))
    return refit(net, np.array([r.value for r in rows], np.float32), *weighed(rows))


def scored(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row of ``docs``, from its text alone.

    A null text counts as empty, and an empty one has a score as any other. Repeated rows are returned as often as they come; an empty
    table gives no rows. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        net = shared.value
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([net.score(t.as_py()) for t in batch.column(1)], pa.float64())], ["id", "score"])

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("t"))
    rows = texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, score double")
    return rows.select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score below the threshold, in one pass: no join, so ids may repeat or be null."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        net = shared.value
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            yield batch.filter(pa.array([net.score(t.as_py() or b"") >= threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
