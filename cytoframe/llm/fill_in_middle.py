"""Fill-in-middle transformation over succinct token boundaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE = 8 << 20  # bytes of text whose bits are made at once; a longer text is a slice of its own
WORDS = 8  # 64-bit words of a block


class BitVector:
    """Bits packed into 64-bit words, with a directory of the ones before each block of WORDS words.

    `rank` and `select` answer many questions at once; each reads one entry of the directory and one block.
    """

    def __init__(self, bits: np.ndarray):
        blocks = len(bits) // (64 * WORDS) + 1
        packed = np.zeros(blocks * WORDS * 8, np.uint8)
        packed[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        self.words = packed.view("<u8").reshape(blocks, WORDS)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).sum(1, dtype=np.int64))])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The ones among the first at[i] bits."""
        block, word, bit = at // (64 * WORDS), at // 64 % WORDS, (at % 64).astype(np.uint64)
        words, place = self.words[block], np.arange(WORDS)
        part = np.where(place < word[:, None], words, np.where(place == word[:, None], words & ((np.uint64(1) << bit) - np.uint64(1))[:, None], np.uint64(0)))
        return self.before[block] + np.bitwise_count(part).sum(1, dtype=np.int64)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the k[i]-th one, counted from 1."""
        block = np.searchsorted(self.before, k, "left") - 1
        rest = k - self.before[block]
        ones = np.cumsum(np.bitwise_count(self.words[block]), axis=1, dtype=np.int64)
        word = (ones < rest[:, None]).sum(1)
        row = np.arange(len(k))
        rest = rest - np.where(word > 0, ones[row, word - 1], 0)
        bits = np.unpackbits(self.words[block, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return block * (64 * WORDS) + word * 64 + (np.cumsum(bits, axis=1) < rest[:, None]).sum(1)


def token_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A bit for each byte: the last of a token. A token is a run of other characters with the blanks before it, or
    the blanks at a text's end. Blanks are ASCII, so bytes stand for code points here."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    ends = np.zeros(len(data), bool)
    ends[:-1] = ~blank[:-1] & blank[1:]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    ends[last] = True
    return ends


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows [from, to) that hold at most SLICE bytes, one row at least."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield at, to
        at = to


def _numbers(seed: int, ids: list) -> np.ndarray:
    """Four 32-bit numbers for each id: the first 16 bytes of sha256 of seed:id."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def _transform(ids: list, texts: pa.Array, seed: int, percent: int, spm_percent: int) -> dict:
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    tokens, chars = BitVector(token_ends(data, offsets)), BitVector((data & 0xC0) != 0x80)
    first = tokens.rank(offsets)
    n = np.diff(first)
    raw = [data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    h = _numbers(seed, ids)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    split = np.flatnonzero((n > 0) & (h[:, 2] % 100 < percent) & np.array([not any(m in t for m in marks) for t in raw], bool))
    form = np.full(len(raw), "plain", object)
    counts: list[list[int | None]] = [[None] * len(raw), [None] * len(raw)]
    if len(split):
        drawn = np.sort(h[split, :2] % (n[split, None] + 1), axis=1)
        cut = [np.where(d > 0, tokens.select(np.maximum(first[split] + d, 1)) + 1, offsets[split]) for d in drawn.T]
        seen = [chars.rank(offsets[split]), *map(chars.rank, cut)]
        spm = h[split, 3] % 100 < spm_percent
        form[split] = np.where(spm, "spm", "psm")
        p, s, m = marks
        rows = zip(split.tolist(), (cut[0] - offsets[split]).tolist(), (cut[1] - offsets[split]).tolist(), spm.tolist(), (seen[1] - seen[0]).tolist(), (seen[2] - seen[1]).tolist())
        for i, a, b, suffix_first, in_prefix, in_middle in rows:
            t = raw[i]
            head = (s, t[b:], p, t[:a]) if suffix_first else (p, t[:a], s, t[b:])
            raw[i] = b"".join((*head, m, t[a:b]))
            counts[0][i], counts[1][i] = in_prefix, in_middle
    return {"n": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()), "prefix_chars": pa.array(counts[0], pa.int64()), "middle_chars": pa.array(counts[1], pa.int64()), "output": pa.array(raw, pa.binary()).cast(pa.string())}


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every whole text, cut at token boundaries.

    The form is psm, spm (`spm_percent` of those that are cut) or plain; numbers drawn from sha256 of seed:id choose it and
    the two cuts. Texts that hold a marker stay plain, and so do empty ones; null texts are empty, a null id is drawn
    as an empty one. A text is one row however long it is; its bits take a quarter of its bytes. Repeated rows and
    rows that share an id are transformed each for itself; an empty table gives none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            for a, b in _slices(texts):
                out = _transform(ids[a:b].to_pylist(), texts[a:b], seed, percent, spm_percent)
                yield pa.RecordBatch.from_arrays([ids[a:b], *out.values()], names=["id", *out])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string").withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text that `fill_in_middle` was given."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    at = lambda k: F.try_element_at(part, F.lit(k))
    return F.when(form == "psm", F.concat(at(2), at(4), at(3))).when(form == "spm", F.concat(at(3), at(4), at(2))).otherwise(output)
