"""Cuts are known by length and ending also where a source adds lines after them."""

from __future__ import annotations

import random

import xxhash

from parcelight.llm import truncated


def test_limit_before_an_added_line(spark, ws, monkeypatch):
    rng, rows = random.Random(3), []
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n - 1)) + "."
    for i in range(900):
        source = "ab"[i % 2] if i >= 300 else "e"
        body = text(rng.randint(150, 480))
        if i < 8:
            body = text(700)[: 498 + i % 3][:-1] + "x"
        rows.append((i, body + (f"\n\n-- copy {10 ** rng.randint(0, 40)} --" if source == "e" else ""), source))
    seen = {}
    train = truncated.train
    monkeypatch.setattr(truncated, "train", lambda *a: seen.update(limits=a[6]) or train(*a))
    truncated.scored(ws, spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert seen["limits"].get("e") == [("b", 500), ("c", 500)]
    assert "a" not in seen["limits"] and "b" not in seen["limits"]


def test_at_limit_without_an_added_line():
    added, text = frozenset(["-- copy 9 --"]), "x" * 499 + "\n\n-- copy 12 --"
    assert truncated._at_limit(text, truncated.strip_added(text, added), [("c", 500)])
    assert not truncated._at_limit(text, truncated.strip_added(text, frozenset()), [("c", 500)])


def test_a_last_block_is_whole():
    block = "1. " + "The panel was installed at the claimant's house. " * 200 + "It is so ordered."
    first = xxhash.xxh32_intdigest("three The panel was") % truncated.WIDTH
    for text in (block, "Heading\n\n" + block, "x. " * 9_000 + "\n \n" + block):
        assert first in truncated.features(text, False)


def test_long_lines_that_a_source_adds(spark, ws):
    line = "This copy was made by the register of the chamber for its own files and isn't an official one: sheet {} of the register"
    long = "This copy was made for the files. " * 20 + "Sheet {}."
    rows = [(i, f"The court finds defect {i * 7919 % 1000} material.\n\n" + ["Clerk", (line if i % 8 else long).format(i)][i % 4 == 0], "abcd"[i % 4]) for i in range(4_000)]
    added = frozenset(truncated.added_lines(truncated.profile(ws, spark.createDataFrame(rows, "doc_id long, text string, source string"), "text", "source")))
    assert {truncated.strip_added(f"x.\n\n{s.format(12)}\n", added) for s in (line, long)} == {"x."}


def test_any_number_of_added_lines(spark, ws):
    notes = ["This copy was made by the register of the chamber. " * 4 + "Sheet {}", "Page {}", "Register of the chamber", "No warranty", "End {} of the copy"]
    block = "The panel was installed at the house. " * 250 + "It is so ordered."
    rows = [(i, f"The court finds defect {i * 7919 % 1000} material.\n\n" + (block if i % 97 == 0 else ["Clerk", "Judge"][i // 4 % 2]) + ("\n\n" + "\n".join(notes).format(i, i, i) if i % 4 == 0 else ""), "abcd"[i % 4]) for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    profiles, added = truncated.bodies(ws, docs, "text", "source")
    assert len(added) == 5
    assert profiles.filter("s = 'a'").agg({"c": "max"}).first()[0] == max(len(t.split("\n\nThis copy")[0]) for _, t, s in rows if s == "a")
    assert truncated.strip_added(rows[97 * 4][1], added).endswith("It is so ordered.")
