"""LM scoring: a causal self-attention model over subword ids, trained in numpy, mixed with word frequencies.

A-Z is lower-cased; tokens are the words `[^\\x20\\x09-\\x0D]+` of a text and one end.  Learnt from rows whose crc32(doc_id as
text) mod 7 is not 2 (a null doc_id is learnt from).

base_score: sum over tokens of log10((c + 1) / (N + V + 1)) with counts over all training texts.  Counts of the HOT_WORDS most
frequent words go to every task; the other words of the texts meet their counts in a join.

score: each word is its subword ids (a public vocabulary, never trained; a word begins with a space).  The model reads
windows of WINDOW ids that overlap by WINDOW - STEP; each id is scored once, in the window where it is among the last STEP,
with masked attention over the ids before it.  It predicts one of CLASSES classes of ids (frequent ids alone, the others by
frequency); an id's share of its class comes from counts over all training texts.  The probability of a word with the ids i, j, ... is
(1 - B) * S(i) * (L * c / C(i) + (1 - L) * P(j) * ... * E) + B * (c + 1) / (N + V + 1), with B = BASE_SHARE.  S(i) is the probability of i among the ids that begin a word, C(i) counts the
words that begin with i, E is the probability that a word begins after the last id, and 1 - L is the share of words seen once.
The end begins a word and is one; score sums the log10.

Training: every id of every training text is predicted once a round.  Texts are cut into chunks of CHUNK ids, each with the ids
before it that its windows read, so a long text is many rows.  A round deals the chunks anew, trains each partition's windows
from the same weights by Adam and averages the results by windows.

Null and empty texts are one end; repeated rows are scored alike and learnt from as often as they come; without training
rows every count is 0 and classes are even.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .passages import NO_ID, keyed
from .stage import staged, table
from .text import LOWER, mix, slices, utf8, word_hashes, words

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"     # read by the driver
PIECE_LIMIT = 64                 # longer words are cut before they are split into ids
CLASSES, WIDTH, WINDOW, STEP = 96, 16, 24, 16
BUCKETS = 2048                   # input rows: frequent ids own one, the others share
ROUNDS, BATCH, RATE = 6, 32, 0.01
CHUNK = 16 * STEP                # ids that a gathered row predicts
PARTITION_WINDOWS = 4096
HOT_WORDS = 200_000
CACHE_WORDS = 300_000
BASE_SHARE = 0.1
BEFORE = WINDOW - STEP + 1       # ids that the first window of a later chunk reads
LOT = 256                        # windows scored at a time
COUNT_WORDS = 2 << 20            # words that a task counts at a time
SCALE = np.float32(WIDTH ** -0.5)
DISTANCE = np.arange(WINDOW - STEP, WINDOW)[:, None] - np.arange(WINDOW)      # from a target's place to an input's
LATER = np.where(DISTANCE < 0, np.float32(-1e9), np.float32(0))                 # masks inputs after the target's place
DISTANCE = np.maximum(DISTANCE, 0)
END_HASH = np.uint64(0xE0D0E0D0E0D0E0D1)


@lru_cache(maxsize=2)
def _encoder(packed: bytes):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, zlib.decompress(packed).splitlines())}
    return tiktoken.Encoding("subwords", pat_str=r"[\s\S]{1,%d}" % PIECE_LIMIT, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1


class Subwords:
    """Ids of words, by word hash; the ids of many words are kept between slices."""

    def __init__(self, packed: bytes):
        self.encoding, self.end = _encoder(packed)                  # the end has the first free id
        self.hashes, self.offsets, self.ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _encode(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        body = data.tobytes()
        texts = [" " + body[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), stops.tolist())]
        lists = [self.encoding.encode_ordinary(t) for t in texts]
        return np.array([i for x in lists for i in x], np.int32), np.array([len(x) for x in lists], np.int64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and the number of ids of each word."""
        unique, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, unique), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == unique if len(self.hashes) else np.zeros(len(unique), bool)
        new = np.flatnonzero(~known)
        ids, sizes = self._encode(data, starts[first[new]], stops[first[new]])
        ends = np.cumsum(sizes)
        begin, size = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        begin[known], size[known] = self.offsets[at[known]], np.diff(self.offsets)[at[known]] if len(self.hashes) else 0
        begin[new], size[new] = len(self.ids) + ends - sizes, sizes
        pool = np.concatenate([self.ids, ids])
        if len(new) and len(self.hashes) < CACHE_WORDS:
            order = np.argsort(np.concatenate([self.hashes, unique[new]]))
            all_begin, all_size = np.concatenate([self.offsets[:-1], begin[new]]), np.concatenate([np.diff(self.offsets), sizes])
            self.hashes = np.concatenate([self.hashes, unique[new]])[order]
            self.ids = _ragged(pool, all_begin[order], all_size[order])
            self.offsets = np.concatenate([[0], np.cumsum(all_size[order])])
        return _ragged(pool, begin[place], size[place]), size[place]


def _ragged(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return pool[np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(begin, size)]


def _tokens(batch: pa.RecordBatch, subwords: Subwords):
    """Word hashes with one end after each row, their rows' offsets, ids of all tokens, ids of each token."""
    data, offsets = utf8(batch.column("text"))
    data = LOWER[data]
    starts, stops, per_row = words(data, offsets)
    hashes = word_hashes(data, starts, stops)
    ids, sizes = subwords(data, starts, stops, hashes)
    rows = len(per_row) - 1
    hashes, sizes_all = np.insert(hashes, per_row[1:], END_HASH), np.insert(sizes, per_row[1:], 1)
    id_ends = np.concatenate([[0], np.cumsum(sizes)])[per_row[1:]]
    return hashes, per_row + np.arange(rows + 1), np.insert(ids, id_ends, subwords.end), sizes_all


def _contexts(ids: np.ndarray, offsets: np.ndarray, begin: np.ndarray, row: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that score ids begin .. begin + STEP of a row: inputs (-1: none), targets and which of them exist."""
    at = begin[:, None] + np.arange(STEP - WINDOW, STEP)             # places of the targets
    low, high = offsets[row][:, None], offsets[row + 1][:, None]
    inside = (at >= low) & (at < high)
    inputs = np.where(at == low, end, ids[np.clip(at - 1, 0, max(len(ids) - 1, 0))])
    inputs = np.where(inside, inputs, -1)
    targets = ids[np.clip(at[:, WINDOW - STEP:], 0, max(len(ids) - 1, 0))]
    return inputs, targets, inside[:, WINDOW - STEP:]


class Attention:
    """One head of causal attention with distances, a residual, and a softmax over classes.

    `qkv` has the matrices of queries, keys and values side by side, `o` that of the classes with their constants as a last row.
    Logits are held as classes x targets, so that sums over classes add whole rows.
    """

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def start(class_share: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[-2])).astype(np.float32)
        return {"e": (rng.normal(size=(BUCKETS + 1, WIDTH)) * 0.3).astype(np.float32), "qkv": np.hstack([draw(WIDTH, WIDTH) for _ in range(3)]),
                "r": np.zeros(WINDOW, np.float32), "o": np.vstack([np.zeros((WIDTH, CLASSES)), np.log(class_share)]).astype(np.float32)}     # starts as the class shares

    def forward(self, inputs: np.ndarray):
        w, n = self.w, len(inputs)
        x = w["e"].take(inputs.ravel(), axis=0)                     # -1 is the last row, and masked
        q, k, v = _parts((x @ w["qkv"]).reshape(n, WINDOW, 3 * WIDTH))
        a = q @ k.transpose(0, 2, 1)
        a *= SCALE
        a += w["r"].take(DISTANCE) + LATER
        none = inputs < 0
        if none.any():
            a += np.where(none, np.float32(-1e9), np.float32(0))[:, None, :]
        a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        a /= (a.reshape(-1, WINDOW) @ np.ones(WINDOW, np.float32)).reshape(n, STEP, 1)
        y = np.ones((n, STEP, WIDTH + 1), np.float32)               # the last column is for the constants
        np.matmul(a, v, out=y[:, :, :WIDTH])
        y[:, :, :WIDTH] += x.reshape(n, WINDOW, WIDTH)[:, WINDOW - STEP:]
        y = y.reshape(-1, WIDTH + 1)
        z = w["o"].T @ y.T
        if max(z.max(), -z.min()) > 60:                             # exp stays finite and above 0 otherwise
            z -= z.max(axis=0)
        return x, q, k, v, a, y, z

    def log_classes(self, inputs: np.ndarray, classes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of the targets' classes, and of all classes that begin a word."""
        z = self.forward(inputs)[-1]
        chosen = z[classes.ravel(), np.arange(z.shape[1])]
        np.exp(z, out=z)
        total = np.ones(len(z), np.float32) @ z
        return (chosen - np.log(total)).reshape(classes.shape), np.log(begins @ z / total + np.float32(1e-20)).reshape(classes.shape)

    def gradients(self, inputs: np.ndarray, classes: np.ndarray, there: np.ndarray, g: dict[str, np.ndarray]) -> None:
        """Gradients of the mean loss of the targets that exist, written to g."""
        w, n, (x, q, k, v, a, y, z) = self.w, len(inputs), self.forward(inputs)
        dz, share = np.exp(z, out=z), there.ravel() / np.float32(max(1, np.count_nonzero(there)))
        dz *= share / (np.ones(len(z), np.float32) @ dz)
        dz[classes.ravel(), np.arange(len(share))] -= share
        np.matmul(y.T, dz.T, out=g["o"])
        dy = (dz.T @ w["o"][:WIDTH].T).reshape(n, STEP, WIDTH)
        ds = dy @ v.transpose(0, 2, 1)
        ds -= np.vecdot(ds, a)[:, :, None]
        ds *= a
        g["r"][:] = np.bincount(DISTANCE.ravel(), ds.sum(axis=0).ravel(), WINDOW)        # 0 for later inputs
        ds *= SCALE
        d = np.zeros((n, WINDOW, 3 * WIDTH), np.float32)
        dq, dk, dv = _parts(d)
        np.matmul(ds, k, out=dq)
        np.matmul(ds.transpose(0, 2, 1), q, out=dk)
        np.matmul(a.transpose(0, 2, 1), dy, out=dv)
        d = d.reshape(-1, 3 * WIDTH)
        np.matmul(x.T, d, out=g["qkv"])
        dx = d @ w["qkv"].T
        dx.reshape(n, WINDOW, WIDTH)[:, WINDOW - STEP:] += dy
        g["e"][:] = 0
        place = np.where(inputs < 0, BUCKETS, inputs).ravel() * WIDTH + np.arange(WIDTH)[:, None]
        np.add.at(g["e"].reshape(-1), place.ravel(), dx.T.ravel())  # flat places, which numpy adds faster than rows
        g["e"][-1] = 0

    def train(self, inputs: np.ndarray, classes: np.ndarray, there: np.ndarray, rate: float, seed: int) -> None:
        """Adam over all windows in batches.  Its means m and v are held as 10 m and 50 v, all weights in one row."""
        flat = np.concatenate([p.ravel() for p in self.w.values()])
        m, v, g = np.zeros((3, len(flat)), np.float32)
        self.w, g_of = _views(flat, self.w), _views(g, self.w)
        order = np.random.default_rng(seed).permutation(len(inputs))
        inputs, classes, there = inputs[order], classes[order], there[order]
        for t, a in enumerate(range(0, len(order), BATCH), 1):
            self.gradients(inputs[a:a + BATCH], classes[a:a + BATCH], there[a:a + BATCH], g_of)
            m *= 0.9
            m += g
            v *= 0.98
            g *= g
            v += g
            size = (0.02 / (1 - 0.98 ** t)) ** 0.5
            step = np.sqrt(v, out=g)
            step += 1e-6 / size
            np.divide(m, step, out=step)
            step *= rate * 0.1 / (1 - 0.9 ** t) / size
            flat -= step


def _parts(qkv: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries of the targets, keys and values."""
    return qkv[:, WINDOW - STEP:, :WIDTH], qkv[:, :, WIDTH:2 * WIDTH], qkv[:, :, 2 * WIDTH:]


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Parts of one row, with the names and shapes of `like`."""
    ends = np.cumsum([0, *(p.size for p in like.values())])
    return {k: flat[a:b].reshape(p.shape) for (k, p), a, b in zip(like.items(), ends[:-1], ends[1:])}


class Ids:
    """Classes of ids and their shares, from counts over all training texts."""

    def __init__(self, counts: np.ndarray, begins: np.ndarray):
        n = len(counts)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        alone = CLASSES - 8                                         # the others in four bands of ranks for each kind
        band = alone + 4 * begins + np.minimum(3, np.log2(np.maximum(rank - alone, 0) / 128 + 1).astype(np.int64) // 2)
        self.classes = np.where(rank < alone, rank, band)
        self.begins = np.zeros(CLASSES, np.float32)                  # classes of ids that begin a word
        self.begins[np.unique(self.classes[begins])] = 1
        weight = counts + 0.5
        total = np.bincount(self.classes, weight, CLASSES)
        self.log_share = np.log(weight / total[self.classes]).astype(np.float32)
        self.class_share = np.maximum(total, 1e-3) / np.maximum(total, 1e-3).sum()
        self.bucket = np.where(rank < BUCKETS - 256, rank, BUCKETS - 256 + (mix(np.arange(n, dtype=np.uint64)) % np.uint64(256)).astype(np.int64))

    def rows(self, inputs: np.ndarray) -> np.ndarray:
        return np.where(inputs < 0, -1, self.bucket[inputs])


def _kind(end: int) -> type:
    return np.uint16 if end < 1 << 16 else np.int32


def _windows(kinds: np.ndarray, n: np.ndarray, bodies: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of chunks with n windows each."""
    size = np.array([len(b) for b in bodies], np.int64) // np.dtype(_kind(end)).itemsize
    sequence = np.frombuffer(b"".join(bodies), _kind(end)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    row = np.repeat(np.arange(len(n)), n)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return _contexts(sequence, offsets, offsets[row] + np.where(kinds[row] == 4, BEFORE, 0) + STEP * turn, row, end)


def _gather(packed: bytes):
    """Counts of words, ids and first ids of words (kinds 0, 1, 3) and chunks of the texts
    (ids in `body`, number of windows in `n`; kind 2 begins a text, kind 4 has BEFORE ids before its own)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, held, size = Subwords(packed), [], 0
        id_counts, first_counts = np.zeros((2, subwords.end + 1), np.int64)

        def counts() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return _rows(0, found.view(np.int64), n)

        for batch in slices(batches):
            hashes, offsets, ids, sizes = _tokens(batch, subwords)
            id_counts += np.bincount(ids, minlength=len(id_counts))
            held.append(hashes)
            size += len(hashes)
            id_offsets = np.concatenate([[0], np.cumsum(sizes)])
            first_counts += np.bincount(ids[id_offsets[:-1]], minlength=len(id_counts))
            id_offsets = id_offsets[offsets]
            n = -(-np.diff(id_offsets) // CHUNK)
            row = np.repeat(np.arange(batch.num_rows), n)
            number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            key = mix(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)[row] + number.astype(np.uint64))
            begin = id_offsets[row] + CHUNK * number
            stop, body = np.minimum(begin + CHUNK, id_offsets[row + 1]), ids.astype(_kind(subwords.end))
            yield _rows(np.where(number > 0, 4, 2), key.view(np.int64), -(-(stop - begin) // STEP),
                        [body[a:b].tobytes() for a, b in zip((begin - np.where(number > 0, BEFORE, 0)).tolist(), stop.tolist())])
            if size >= COUNT_WORDS:
                yield counts()
                held, size = [], 0
        if held:
            yield counts()
        for kind, x in ((1, id_counts), (3, first_counts)):
            some = np.flatnonzero(x)
            yield _rows(kind, some, x[some])
    return run


def _rows(kind: int | np.ndarray, key: np.ndarray, n: np.ndarray, body: list | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64)),
                                       pa.array(body if body is not None else [None] * len(key), pa.binary())], ["kind", "h", "n", "body"])


def _train_round(weights: dict[str, np.ndarray], ids: Ids, rate: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        model = Attention({n: p.copy() for n, p in weights.items()})
        pdf = pdf.sort_values(["h", "body"], kind="stable")
        inputs, targets, there = _windows(pdf["kind"].to_numpy(), pdf["n"].to_numpy(), list(pdf["body"]), len(ids.classes) - 1)
        model.train(ids.rows(inputs), ids.classes[targets], there, rate, len(inputs))
        flat = np.concatenate([p.ravel() for p in model.w.values()]).astype(np.float64)
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "n": [len(inputs)], "body": [(flat * len(inputs)).tobytes()]})
    return run


def _sum_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for all partitions that a task trained."""
    part, n, total = 0, 0, None
    for pdf in frames:
        for body in pdf["body"]:
            flat = np.frombuffer(body, np.float64)
            total = flat.copy() if total is None else total + flat
        part, n = int(pdf["part"].iloc[0]) if len(pdf) else part, n + int(pdf["n"].sum())
    if n:
        yield pd.DataFrame({"part": [part], "n": [n], "body": [total.tobytes()]})


def _sum_weights(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(b, np.float64) for b in pdf["body"]], axis=0)
    return pd.DataFrame({"n": [int(pdf["n"].sum())], "body": [total.tobytes()]})


def train(chunks: DataFrame, ids: Ids, rounds: int = ROUNDS) -> Attention:
    """Model of staged chunks (kind, h, n, body): partitions train apart, their weights are averaged in steps."""
    weights, n = Attention.start(ids.class_share), chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = n // PARTITION_WINDOWS + 1
    for r in range(rounds if n else 0):
        turned = chunks.withColumn("part", F.pmod(F.xxhash64("h", F.lit(r)), F.lit(parts)))
        trained = turned.groupBy("part").applyInPandas(_train_round(weights, ids, RATE / (1 + r) ** 0.5), "part long, n long, body binary")
        trained = trained.mapInPandas(_sum_task, "part long, n long, body binary")
        sums = trained.groupBy(F.pmod("part", F.lit(32)).alias("g")).applyInPandas(_sum_weights, "n long, body binary").collect()
        flat = np.sum([np.frombuffer(x["body"], np.float64) for x in sums], axis=0) / sum(x["n"] for x in sums)
        weights = _views(flat.astype(np.float32), weights)
    return Attention(weights)


def id_scores(model: Attention, ids: Ids, sequence: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each id, each scored once, and that any id there begins a word."""
    sizes = np.diff(offsets)
    n = -(-sizes // STEP)
    row = np.repeat(np.arange(len(sizes)), n)
    begin = offsets[row] + STEP * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
    out, begins = np.empty((2, len(sequence)), np.float32)
    for a in range(0, len(row), LOT):
        inputs, targets, there = _contexts(sequence, offsets, begin[a:a + LOT], row[a:a + LOT], end)
        found, first = model.log_classes(ids.rows(inputs), ids.classes[targets], ids.begins)
        place = (begin[a:a + LOT, None] + np.arange(STEP))[there]
        out[place], begins[place] = found[there], first[there]
    return out + ids.log_share[sequence], begins


def _score(packed: bytes, model: Attention, ids: Ids, log_first: np.ndarray, seen: float, hot: np.ndarray, hot_count: np.ndarray,
           total: int, distinct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = Subwords(packed)
        for batch in slices(batches):
            hashes, offsets, sequence, sizes = _tokens(batch, subwords)
            id_offsets = np.concatenate([[0], np.cumsum(sizes)])
            log_p, begins = id_scores(model, ids, sequence, id_offsets[offsets], subwords.end)
            first = id_offsets[:-1]
            ended = np.append(begins[first[1:]], np.float32(0))       # a word begins after it; nothing follows an end
            ended[offsets[1:] - 1] = 0
            word = np.add.reduceat(log_p.astype(np.float64), first) - begins[first] + ended
            lead = log_p[first] - begins[first] - log_first[sequence[first]]
            at = np.minimum(np.searchsorted(hot, hashes), max(len(hot) - 1, 0))
            known = hot[at] == hashes if len(hot) else np.zeros(len(hashes), bool)
            count = np.where(known, hot_count[at], 0) if len(hot) else np.zeros(len(hashes))
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            base = np.log10((count + 1) / (total + distinct + 1))
            mixed = np.log10((1 - BASE_SHARE) * (seen * count * np.exp(lead) + (1 - seen) * np.exp(np.maximum(word, -700))) + BASE_SHARE * 10 ** base)
            sums = [np.bincount(row, np.where(known, x, 0), batch.num_rows) for x in (base, mixed, known)]
            cold = np.flatnonzero(~known)
            cuts = np.searchsorted(row[cold], np.arange(batch.num_rows + 1)).astype(np.int32)
            column = lambda x, t: pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[cold], t))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("key"), pa.array(np.diff(offsets)), pa.array(sums[2].astype(np.int64)), pa.array(sums[0]),
                pa.array(sums[1]), column(hashes.view(np.int64), pa.int64()), column(word.astype(np.float32), pa.float32()), column(lead.astype(np.float32), pa.float32())],
                ["id", "key", "n_tokens", "n_known", "base", "mixed", "h", "p", "lead"])
    return run


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def lm_scores(docs: DataFrame, training: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score for each row of docs."""
    with open(vocabulary, "rb") as file:
        packed = zlib.compress(file.read())
    end = _encoder(packed)[1]
    gathered = staged(keyed(training).mapInArrow(_gather(packed), "kind int, h long, n long, body binary"))
    counts = staged(gathered.filter("kind = 0").groupBy("h").agg(F.sum("n").alias("c")))
    total, distinct, once = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("c") == 1)).first()
    id_counts, first_counts = np.zeros((2, end + 1), np.int64)
    for kind, i, n in gathered.filter("kind IN (1, 3)").groupBy("kind", "h").agg(F.sum("n")).collect():  # as many as ids
        (id_counts if kind == 1 else first_counts)[i] = n
    seen = float(np.clip(1 - once / max(total, 1), 0.01, 0.99))
    log_first = np.log(np.maximum(first_counts, 1))
    encoding = _encoder(packed)[0]
    begins = np.array([encoding.decode_single_token_bytes(i)[:1] == b" " for i in range(end)] + [True])
    ids = Ids(id_counts, begins)
    model = train(gathered.filter("kind IN (2, 4)").select("kind", "h", "n", "body"), ids)
    top = counts.orderBy(F.desc("c"), "h").limit(HOT_WORDS).toPandas()
    order = np.argsort(top["h"].to_numpy(np.int64).view(np.uint64))
    hot, hot_count = top["h"].to_numpy(np.int64).view(np.uint64)[order], top["c"].to_numpy(np.int64)[order]
    rows = staged(keyed(docs).mapInArrow(_score(packed, model, ids, log_first, seen, hot, hot_count, total, distinct),
                                         "id long, key long, n_tokens long, n_known long, base double, mixed double, h array<long>, p array<float>, lead array<float>"))
    cold = rows.select("id", "key", F.inline(F.arrays_zip("h", "p", "lead"))).join(counts, "h", "left")
    c = F.coalesce("c", F.lit(0))
    base = (c + 1) / F.lit(float(total + distinct + 1))
    model_p = seen * c * F.exp(F.col("lead").cast("double")) + (1 - seen) * F.exp(F.greatest(F.col("p").cast("double"), F.lit(-700.0)))
    cold = cold.groupBy("id", "key").agg(
        F.count("c").alias("k"), F.sum(F.log10(base)).alias("b"),
        F.sum(F.log10((1 - BASE_SHARE) * model_p + BASE_SHARE * base)).alias("m"))
    alike = rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("alike"))              # repeated rows share a key
    cold = cold.join(alike, ["id", "key"])
    found = rows.drop("h", "p", "lead").join(cold, ["id", "key"], "left")
    share = lambda x: F.coalesce(F.col(x) / F.col("alike"), F.lit(0.0))
    return found.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_tokens", (F.col("n_known") + share("k")).cast("long").alias("n_known"),
                        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + share("b")).alias("base_score"),
                        (F.col("mixed") + share("m")).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scores = lm_scores(docs, docs.filter(~held_out()))
    return scores.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
