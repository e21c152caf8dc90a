"""Limits on loss-bearing tokens that bind, from documents to sequences."""

import zlib

import numpy as np
import pytest

import public_tokenizers as public
from cytoframe.llm import packing

ARGS = public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN
ROWS = [(i, "question words " * (i * 37 % 300), "answer here " * (i * 11 % 120)) for i in range(80)] + [(80, None, "answer " * 700), (81, "long prompt " * 900, None), (82, "", "")]


@pytest.mark.parametrize("prompt", [None, "prompt"])
@pytest.mark.parametrize("max_loss", [40, 300, 5000])
def test_loss_limit_binds(spark, prompt, max_loss):
    df = spark.createDataFrame(ROWS, "doc_id long, prompt string, text string")
    got = packing.pack_documents(df, *ARGS, size=512, max_segments=6, max_loss=max_loss, prompt_col=prompt).toPandas()
    ids = [packing.tokenise([p or "", t or ""], *ARGS) for _, p, t in ROWS]
    for (key, _, _), (p, t) in zip(ROWS, ids):
        own, at, silent = np.array([*(p if prompt else []), *t, 1], "<u4"), 0, len(p) if prompt else 0
        for r in got[got["doc_id"] == key].sort_values("start").itertuples():
            assert r.start == at and r.ids_crc32 == zlib.crc32(own[at : at + r.length].tobytes())
            assert r.loss_tokens == sum(x >= silent for x in range(at, at + r.length))
            at += r.length
        assert at == len(own)
    for _, s in got.groupby("sequence_id"):
        assert s["length"].sum() <= 512 and len(s) <= 6 and s["loss_tokens"].sum() <= max_loss
    if max_loss < 512:
        assert got.groupby("sequence_id")["loss_tokens"].sum().max() == max_loss
