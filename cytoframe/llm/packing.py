"""Vector bin packing of tokenised documents into training sequences."""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, functions as F

from .common import Scratch

#: Runs that the ranks' pattern cannot take: its matcher needs a stack frame for each character.
LONG_RUN = re.compile(r"\s{20000}")


@functools.cache
def _encoder(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _tokenizer(json_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


def tokenise(texts: list[str], json_path: str, ranks_path: str | None, pattern: str, specials: tuple[str, ...] = ("<|endoftext|>",)) -> list[list[int]]:
    """The ids of byte_bpe json tokenizers. Where the same vocabulary lies as ranks, these give the same ids five
    times faster; texts that hold a special token's string or a very long run of blanks go to the json tokenizer all the same."""
    if ranks_path is None:
        return [e.ids for e in _tokenizer(json_path).encode_batch(texts, add_special_tokens=False)]
    fast = _encoder(ranks_path, pattern).encode_ordinary
    odd = lambda t: any(s in t for s in specials) or len(t) >= 20_000 and LONG_RUN.search(t)
    return [_tokenizer(json_path).encode(t, add_special_tokens=False).ids if odd(t) else fast(t) for t in texts]


def pack_vectors(items: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The bin of every item (rows: demands in each dimension), by the dot-product heuristic, bin by bin.

    An open bin takes the item that fits and has the largest dot product of its demands with what the bin has
    left, both as parts of the limits; when none fits, the next bin is opened. Items of equal demands are
    kept as one class with a count, so a step costs as many products as there are different demands.
    An item above a limit on its own gets a bin of its own.
    """
    bins = np.full(len(items), -1, np.int64)
    if not len(items):
        return bins
    kinds, kind = np.unique(items, axis=0, return_inverse=True)
    kind = kind.ravel()
    order = np.argsort(kind, kind="stable")
    begin = np.searchsorted(kind[order], np.arange(len(kinds) + 1))
    left, at = np.diff(begin), begin[:-1].copy()
    part = kinds / limits
    b, open_ = 0, len(items)
    alive = np.arange(len(kinds))
    while open_:
        room = limits.astype(float).copy()
        filled = 0
        cand = alive[left[alive] > 0]
        alive = cand
        while len(cand):
            cand = cand[(kinds[cand] <= room).all(axis=1) & (left[cand] > 0)]
            if not len(cand):
                break
            pick = cand[np.argmax(part[cand] @ (room / limits))]
            bins[order[at[pick]]] = b
            at[pick] += 1
            left[pick] -= 1
            room -= kinds[pick]
            filled += 1
        if not filled:  # larger than a whole bin
            pick = alive[0]
            bins[order[at[pick]]] = b
            at[pick] += 1
            left[pick] -= 1
            filled = 1
        open_ -= filled
        b += 1
    return bins


def pack_documents(
    docs: DataFrame, json_path: str, ranks_path: str | None, pattern: str, size: int = 2048, max_segments: int = 256, max_loss: int | None = None,
    end_id: int = 1, group_rows: int = 4096, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    A document's ids end with `end_id`. With `prompt_col`, the ids of that text come first and bear no loss, those of
    the text after it and the end do; plain text learns from every token. Ids are cut after every `size`, and
    before a piece would hold more than `max_loss` loss-bearing tokens (size if None). Pieces of `size` are
    sequences of their own, and shorter ones are packed with others under limits on tokens, segments and
    loss-bearing tokens. Pieces are written with the number of their row in its task, and dealt by a hash of all to
    groups of about `group_rows`, so that rows repeated any number of times spread as well; each group is packed in
    one task and leaves one sequence or so that is not full. sequence_id holds the group in its upper half.
    Null texts and prompts count as empty: a document of one id at least; null ids are documents too. Equal rows are
    packed each for itself. An empty table gives no piece; texts of any length are tokenised whole; other columns are
    not read.
    """
    max_loss = size if max_loss is None else max_loss
    if min(size, max_segments, max_loss) < 1:
        raise ValueError("limits are 1 at least")
    limits = np.array([size, max_segments, max_loss])
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = 0
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo : lo + 256]
                rows = []
                tokens = tokenise([t or "" for t in part["text"]], json_path, ranks_path, pattern)
                prompts = tokenise([t or "" for t in part["prompt"]], json_path, ranks_path, pattern) if prompt_col else [[]] * len(part)
                for key, prompt, ids in zip(part["id"], prompts, tokens):
                    silent = len(prompt)
                    ids = np.array([*prompt, *ids, end_id], "<u4")
                    n, start = len(ids), 0
                    while start < n:
                        end = min(start + size, n, max(start, silent) + max_loss)
                        rows.append((key, start, end - start, zlib.crc32(ids[start:end].tobytes()), n, end - min(max(start, silent), end), row))
                        start = end
                    row += 1
                yield pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "row"])

    given = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), *([docs[prompt_col].alias("prompt")] if prompt_col else []))
    pieces = given.mapInPandas(cut, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, row long")
    pieces = Scratch(docs.sparkSession, "packing").write(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_rows))
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("id", "start", "ids_crc32", "length", "row"), F.lit(groups))).drop("row")

    def pack(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["length", "id", "start", "ids_crc32", "loss_tokens"], ascending=[False, True, True, True, True], na_position="first").reset_index(drop=True)
        n, loss = batch["length"].to_numpy(), batch["loss_tokens"].to_numpy()
        rest = n < size
        bins = np.empty(len(batch), np.int64)
        bins[~rest] = np.arange((~rest).sum())
        bins[rest] = pack_vectors(np.stack([n[rest], np.ones(rest.sum(), np.int64), loss[rest]], axis=1), limits) + (~rest).sum()
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(n[order]) - n[order]
        first = np.r_[True, bins[order][1:] != bins[order][:-1]]
        offset = np.empty(len(batch), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        return batch.assign(sequence_id=batch["g"].astype("int64") * (1 << 32) + bins, offset=offset)[["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]]

    packed = dealt.groupBy("g").applyInPandas(pack, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long")
    return packed.withColumnRenamed("id", id_col)
