"""Language ID by cross-parsing: the language whose suffix automaton cuts a text into the fewest phrases.

Each language has a suffix automaton of labelled text.  A text is cut from left to right into longest matches with it;
phrases times log2 of the training length, over the symbols of the text, are the bits a symbol takes.  The language with
the fewest wins; ties go to the smaller name.  A symbol is a UTF-8 byte, A-Z lower-cased; a run of ASCII other than
letters is one space.  Texts are parsed whole, in pieces of PIECE symbols that are counted together, many in lockstep: the
automaton with its restarts is one table of transitions.

Training reads only rows with text, lang and doc_id whose crc32(doc_id as text) mod 3 is not 1.  It is a bounded sample:
for each lang the SAMPLE_DOCS rows of the smallest doc_id hashes, at most SAMPLE_BYTES symbols in all, shared out evenly.
A text longer than its share gives pieces at equal distances from its beginning to its end, so a notice that opens many
texts does not stand for them.  A repeated doc_id counts once (its smallest text).  Null texts and
texts without a letter get `und` and score 0; without any training row all get `und`.  The score is b / (a + b) for the
best and second bits a and b, 1 if there is one language.  Repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .stage import table
from .text import LOWER, slices, utf8

SAMPLE_DOCS = 48
SAMPLE_BYTES = 16_000
STRETCHES, STRETCH = 16, 64         # a text that is not taken whole: pieces, least symbols of one
PIECE = 256
_LETTER = np.isin(np.arange(256), [*range(0x61, 0x7B), *range(0x80, 0x100)])
_TO_SPACE = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint8)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters with single spaces, row after row."""
    data = _TO_SPACE[LOWER[data]]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    heads = offsets[:-1][offsets[:-1] < len(data)]
    keep[heads] = True
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = state
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return follow


class Model:
    """Transitions of all languages in one table.  A cell holds 4 * next row + phrases that end there."""

    def __init__(self, texts: dict[str, list[bytes]]):
        self.langs = sorted(texts)
        known = sorted({c for parts in texts.values() for t in parts for c in t} | {0x20})
        self.code = np.full(256, len(known), np.int64)              # unseen symbols share a column
        self.code[known] = np.arange(len(known))
        self.width = len(known) + 2                                 # and padding has the last
        tables, self.roots, self.bits, at = [], [], [], 0
        for lang in self.langs:
            follow = suffix_automaton(b"\x00".join(texts[lang]))
            cells = np.full((len(follow), self.width), -1, np.int64)
            for state, moves in enumerate(follow):
                for c, to in moves.items():
                    if c:                                           # no match crosses two training texts
                        cells[state, self.code[c]] = to
            root = np.where(cells[0] < 0, 1, 4 * (cells[0] + at))    # an unseen symbol is a phrase of its own
            root = np.where(cells[0] < 0, 4 * at + 1, root)
            full = np.where(cells >= 0, 4 * (cells + at), root + 1)
            full[0] = root
            full[:, -1] = 4 * (np.arange(len(follow)) + at)
            tables.append(full)
            self.roots.append(at)
            self.bits.append(np.log2(max(2, sum(map(len, texts[lang])))))
            at += len(follow)
        self.table = np.concatenate(tables).astype(np.int32).ravel() if tables else np.zeros(0, np.int32)

    def entropies(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits a symbol for each row and language."""
        data, offsets = symbols(data, offsets)
        n = np.diff(offsets)
        pieces = -(-n // PIECE)
        row = np.repeat(np.arange(len(n)), pieces)
        begin = np.repeat(offsets[:-1], pieces) + PIECE * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        size = np.minimum(PIECE, offsets[1:][row] - begin)
        order = np.argsort(-size, kind="stable")
        row, begin, size = row[order], begin[order], size[order]
        codes = np.append(self.code[data], self.width - 1).astype(np.int32)
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(row), axis=1)
        phrases = np.zeros(state.shape, np.int32)
        for t in range(int(size.max(initial=0))):
            live = np.searchsorted(-size, -t)                       # pieces longer than t come first
            cell = self.table[state[:, :live] * self.width + codes[begin[:live] + t]]
            state[:, :live] = cell >> 2
            phrases[:, :live] += cell & 3
        phrases += state != roots
        total = np.zeros((len(n), len(self.langs)))
        np.add.at(total, row, phrases.T)
        return total * np.array(self.bits) / (n[:, None] + 1)


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            letters = batch.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
            if model.langs:
                bits = model.entropies(*utf8(batch.column("text")))
                order = np.argsort(bits, axis=1, kind="stable")
                best = np.take_along_axis(bits, order, 1)
                score = best[:, 1] / np.maximum(best[:, 0] + best[:, 1], 1e-300) if len(model.langs) > 1 else np.ones(len(bits))
                names = np.array(model.langs, object)[order[:, 0]]
            else:
                letters, best, score, names = letters & False, np.zeros((len(letters), 1)), np.zeros(len(letters)), np.full(len(letters), "und", object)
            rest = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "_letters"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(np.where(letters, names, "und"), pa.string()), pa.array(np.where(letters, score, 0.0)),
                 pa.array(np.where(letters, best[:, 0], 0.0))],
                [*[c for c in batch.schema.names if c != "_letters"], "lang_pred", "score", "bits"])
    return run


def spread_over(text: str, most: int) -> Column:
    """A text of up to `most` characters whole, a longer one as STRETCHES pieces from its beginning to its end."""
    width, n = max(1, most // STRETCHES), F.length(text)
    at = F.transform(F.sequence(F.lit(0), F.lit(STRETCHES - 1)), lambda i: F.floor(i * (n - width) / max(1, STRETCHES - 1)).cast("int") + 1)
    return F.when(n <= most, F.array(F.col(text))).otherwise(F.transform(at, lambda a: F.substr(F.col(text), a, F.lit(width))))


def stretches(body: bytes, share: int) -> list[bytes]:
    """`share` symbols of a text, taken at equal distances from its beginning to its end."""
    if len(body) <= share:
        return [body]
    n = max(1, min(STRETCHES, share // STRETCH))
    width = max(1, share // n)
    return [body[at:at + width] for at in ([(len(body) - width) * i // max(1, n - 1) for i in range(n)] if n > 1 else [(len(body) - width) // 2])]


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Model of the rows of labelled (doc_id, lang, text): a bounded sample for each lang."""
    rows = labelled.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = rows.select("doc_id", "lang").distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= sample_docs).drop("r")
    texts: dict[str, list[bytes]] = {}
    sampled = rows.join(picked, ["doc_id", "lang"]).groupBy("lang", "doc_id").agg(F.min(spread_over("text", sample_bytes)).alias("parts"))
    for lang, _, held in sorted(sampled.collect()):
        bodies = [part.encode() for part in held]
        ends = np.cumsum([0, *map(len, bodies)])
        data, offsets = symbols(np.frombuffer(b"".join(bodies), np.uint8), ends)
        texts.setdefault(lang, []).append(b"".join(data[x:y].tobytes() for x, y in zip(offsets, offsets[1:])))
    for lang, parts in texts.items():
        left, parts[:] = sample_bytes, sorted(parts, key=len)
        kept: list[bytes] = []
        for i, p in enumerate(parts):
            share = max(1, left // (len(parts) - i))
            taken = stretches(p, share)
            left -= sum(map(len, taken))
            kept += taken
        texts[lang] = [p for p in kept if p]
    return Model({lang: parts for lang, parts in texts.items() if parts})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score and bits (of the winner), in place of columns of these names.  Only text is read for it."""
    docs = docs.drop("lang_pred", "score", "bits")
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.withColumn("_letters", letters).mapInArrow(_predict(model), f"{schema}, lang_pred string, score double, bits double")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
