"""Token ids, containers and cut texts."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelight.llm import packing, tokens, truncated

from ..conftest import DATA

ODD = ["", None, " ", "\n\n", "a" * 20_000, "é" * 9_000, " " * 9_000, "\n" * 5_000 + "x", "ab " * 5_000, "1" * 10_000, "it's " * 4_000, "漢字" * 4_000, " a  b   c" * 2_000, "﻿x\r\n\ty", "<|endoftext|> a", "👍🏽 🔧" * 800, "x\x00y", "same text", "same text"]


def encode(text):
    return tokens.encoder(tokens.TOKENIZERS, tokens.BYTE_BPE).encode_ordinary(text or "")


def test_ids_match_encoding_whole_texts(spark, tmp_path):
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()] + ODD
    path = str(tmp_path / "docs")
    rows = [(i if i % 50 else None, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "repeated key", "clash", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, chunks string, split int").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    got = tokens.token_ids(docs).collect()
    want = sorted((k if k is not None else -1, encode(t)) for k, t, _, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == want
    counts = tokens.token_counts(docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n) for r in counts) == sorted((k, len(ids)) for k, ids in want)


def test_ids_match_the_other_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{tokens.TOKENIZERS}/{tokens.BYTE_BPE}.json")
    other.encode_special_tokens = True
    for t in ODD:
        assert other.encode(t or "", add_special_tokens=False).ids == encode(t)


def test_no_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    assert tokens.token_ids(docs).count() == 0 and tokens.token_counts(docs).count() == 0


def chunks_of(text):
    data = np.frombuffer(text.encode(), "uint8")
    starts = tokens.chunk_starts(data, np.array([0, len(data)]))
    return [bytes(data[a:b]).decode() for a, b in zip(starts, np.append(starts[1:], len(data)))]


def test_cuts_depend_on_the_text_alone():
    rng = random.Random(4)
    words = ["roof", "panel", "the", "court", "finds", "défaut", "42", "(para.", "tile)"]
    a, b = (" ".join(rng.choice(words) for _ in range(3_000)) for _ in range(2))
    data = np.frombuffer((b + a).encode(), "uint8")
    n = len(b.encode())
    starts = tokens.chunk_starts(data, np.array([0, n, len(data)]))
    assert [s - n for s in starts if s >= n] == list(tokens.chunk_starts(data[n:], np.array([0, len(data) - n])))
    shared = set(chunks_of(a)) & set(chunks_of("An inserted beginning. " + a))
    assert len(shared) > 0.9 * len(set(chunks_of(a)))  # content decides, not the place


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "é", "漢", " ", "  ", "\n", "'s", "9", ".", "　", "\xa0", "'", "ll", "👍"]), max_size=80), st.lists(st.integers(1, 79), max_size=6))
def test_repair_restores_the_encoding_after_any_cut(parts, cuts):
    text = "".join(parts)
    bounds = [0, *sorted({c for c in cuts if c < len(text)}), len(text)]
    ids, joins = [], []
    for a, b in zip(bounds, bounds[1:]):
        if a:
            joins.append(len(ids))
        ids += encode(text[a:b])
    assert tokens.repair(ids, joins, tokens.TOKENIZERS, tokens.BYTE_BPE) == encode(text)


def test_best_fit():
    p = packing.Packer(10, most_open=2)
    assert [p.put(n) for n in (6, 7, 3, 4, 10, 5, 5)] == [0, 1, 1, 0, 2, 3, 3]
    q = packing.Packer(10, most_open=2)
    assert [q.put(n) for n in (6, 7, 8, 4, 2, 3)] == [0, 1, 2, 0, 2, 3]  # the fullest, 1, closed before 2 opened


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 12))
def test_containers_never_overflow(sizes, most_open):
    p, filled = packing.Packer(50, most_open), {}
    for n in sizes:
        c = p.put(n)
        filled[c] = filled.get(c, 0) + n
        assert p.open <= most_open and filled[c] <= 50
    assert p.open == sum(bin_.__len__() for bin_ in p.by_free.values())


def test_packing(spark, ws):
    rng = random.Random(6)
    sizes = [(i if i % 9 else None, rng.choice([0, None, 1, 300, 2048, 2049, 5000, rng.randint(1, 1500)]), 7) for i in range(3_000)]
    rows = packing.pack(ws, spark.createDataFrame(sizes, "k long, n long, size int"), "k").collect()
    filled, total = {}, 0
    for r in rows:
        if r.size:
            filled[r.container_id] = filled.get(r.container_id, 0) + r.size
            total += r.size
        else:
            assert r.container_id is None
    assert total == sum(n or 0 for _, n, _ in sizes) and max(filled.values()) <= 2048
    assert len(rows) == sum(max(1, -(-(n or 0) // 2048)) for _, n, _ in sizes)  # only what exceeds a container is split
    assert len(filled) <= 1.05 * -(-total // 2048) + 3
    assert packing.pack(ws, spark.createDataFrame([], "k long, n long"), "k").count() == 0


SENTENCES = ["The court finds the defect material.", "Counsel for the claimant relies on s. 12 of the Roof Act.", "It is common ground that the panel was installed at Quillby before 7 August 2022.", "Von den 12 Aufnahmen zeigen nur 4 die Dachanlage.", "Le moyen est écarté, la commune l'a nié."]
ENDS = ["It is so ordered.", "Judge Brenlan", "Solicitors: Marr & Velt", "Dated at Quillby this 3 May 2021", "(signed) Clerk of the Chamber", "1. Appeal allowed\n2. No order as to costs", ""]


def decisions(n, seed):
    """(doc_id, text, source, cut): whole decisions, and cut ones in three ways; one source adds a line."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = "\n\n".join(" ".join(rng.choice(SENTENCES) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(2, 8)))
        end = rng.choice(ENDS)
        text = f"{text}\n\n{end}" if end else text
        source = rng.choice(["a", "b", "c", "d"])
        cut = False
        if source == "a" and len(text) > 400:
            text, cut = text[:400], not re.search(r"[.!?]$", text[:400])
        elif source == "b" and rng.random() < 0.2:
            at = rng.randrange(60, max(61, text.rfind("\n\n") - 1)) if text.rfind("\n\n") > 62 else 0
            if at and text[at - 1] not in ".\n" and text[at] not in ".\n":
                text, cut = text[:at], True
        if source == "b":
            text += f"\n\n-- copy {rng.randint(1, 999)} --"
        out.append((i, text, source, cut))
    return out


def test_cut_texts_are_found(spark, ws):
    rows = decisions(4_000, 8)
    odd = [(-1, None, "a", False), (-2, "", "a", False), (-3, " \n ", None, False), (-4, "\x00", "a", False), (-5, "x. " * 60_000, None, False)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows + odd], "doc_id long, text string, source string, cut boolean, s string, line int")
    got = {r.doc_id: r.margin > 0 for r in truncated.scored(ws, df).collect()}
    assert len(got) == len(rows) + len(odd)
    assert not any(got[i] for i in (-1, -2, -3, -4, -5))
    hit = sum(got[i] and cut for i, _, _, cut in rows)
    found, real = sum(got[i] for i, *_ in rows), sum(cut for *_, cut in rows)
    assert hit / real > 0.95 and hit / found > 0.95


def test_held_out_artificial_cuts_are_found(spark, ws):
    docs = spark.read.parquet(DATA.replace("sf0.001", "sf0.01") + "/documents.parquet")
    rows = truncated.profile(ws, docs, "text", "source")
    added, limits = truncated.added_lines(rows), truncated.length_limits(rows)
    even = docs.filter("doc_id % 2 = 0")
    w = truncated.train(even, even.count(), "doc_id", "text", "source", added, limits)
    rng, hits, n = random.Random(0), 0, 0
    for r in docs.filter("doc_id % 2 = 1 and length(text) > 300").collect():
        cut = truncated.artificial_cut(truncated.strip_added(r.text, frozenset(added)), rng)
        if cut:
            n += 1
            hits += w[truncated.features(cut, False)].sum() > 0
    assert n > 200 and hits / n > 0.93


def test_added_lines_and_limits(spark, ws):
    p = truncated.profile(ws, spark.createDataFrame([r[:3] for r in decisions(4_000, 9)], "doc_id long, text string, source string"), "text", "source")
    assert "-- copy 9 --" in truncated.added_lines(p)
    assert ("c", 400) in truncated.length_limits(p)["a"]
    rng = random.Random(1)  # formulas that all sources use alike aren't theirs
    rows = [(i, f"The court finds.\n\n{rng.choice(ENDS)}" + (f"\n\n-- copy {i} --" if i % 4 == 0 and rng.random() < 0.4 else ""), "abcd"[i % 4]) for i in range(4_000)]
    p = truncated.profile(ws, spark.createDataFrame(rows, "doc_id long, text string, source string"), "text", "source")
    assert truncated.added_lines(p) == ["-- copy 9 --"]
    assert truncated.strip_added("x.\n\n-- copy 12 --\n", frozenset(["-- copy 9 --"])) == "x."


@pytest.mark.parametrize("texts", [[], [None], [""], ["one line."]])
def test_nothing_to_learn_from(spark, ws, texts):
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, source string")
    assert [r.margin > 0 for r in truncated.scored(ws, df).collect()] == [False] * len(texts)
    assert truncated.scored(ws, df).select(F.max("margin")).first()[0] in (None, 0.0, -30.0)


def _as_read(docs):
    return sorted(((k, encode(t)) for k, t in docs), key=str)


@pytest.mark.parametrize("form", ["repartitioned", "shuffled", "joined", "in memory"])
def test_any_input_gives_the_ids(spark, form):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    want = _as_read([(r.doc_id, r.text) for r in docs.collect()])
    if form == "repartitioned":
        docs = docs.repartition(7)
    elif form == "shuffled":
        docs = docs.repartition(3, "lang").orderBy(F.rand(3))
    elif form == "joined":
        docs = docs.join(spark.range(10_000).withColumnRenamed("id", "doc_id"), "doc_id")
    else:
        docs = spark.createDataFrame([(r.doc_id, r.text) for r in docs.collect()], "doc_id long, text string")
    assert sorted(((r.doc_id, r.ids) for r in tokens.token_ids(docs).collect()), key=str) == want
    assert sorted(((r.doc_id, r.n) for r in tokens.token_counts(docs).collect()), key=str) == sorted(((k, len(ids)) for k, ids in want), key=str)


def test_forgotten_chunks_are_encoded_again(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(100)
    run = tokens._encode(tokens.TOKENIZERS, tokens.BYTE_BPE, False)
    asked = list(tokens._cut(1, 4096)([pa.RecordBatch.from_pylist([{"split": 0, "key": r.doc_id, "text": r.text} for r in docs.collect()])]))
    whole = [b.to_pylist() for b in run(iter(asked))]
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    assert [b.to_pylist() for b in run(iter(asked))] == whole
