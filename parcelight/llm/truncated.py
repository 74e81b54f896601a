"""Texts that were cut off, found by a logistic regression that learns from artificial cuts."""

from __future__ import annotations

import itertools
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.runtime import Workspace

#: Intact texts that the model is fitted on, at most about this many (a sample by hash of the key); each also gives an artificial cut.
SAMPLE = 20_000
#: Hashed features, and rounds of the fit.
WIDTH, EPOCHS = 1 << 16, 60
#: Examples in which a feature must occur to count, and the share of artificial cuts that get a length at a limit.
OFTEN, LIMITED = 5, 0.1
#: Lines longer than this are compared by a hash, which keeps tables of lines small.
LINE = 80

_TERMINAL = ".!?。！？"
_CLOSERS = "\"'”’»›)]}」』）"
_MARKER = re.compile(r"^\s*(?:\[\d+\]|\(?\d+\)|\d+[.ºna]*[.)]?º?)[\s\t]+")
_BLANKS = " \t\r\n\x00\x0b\x0c\xa0\ufeff"
#: A full stop after which the sentence goes on: before a small letter or a number, and in a date (3. Mai 2021).
_INNER_STOP = re.compile(r"(?<=\w)\. (?=[0-9a-zà-ÿ])|(?<= \d)\. (?=[A-ZÀ-Þ]\w{2,} (?:19|20)\d\d)|(?<= \d\d)\. (?=[A-ZÀ-Þ]\w{2,} (?:19|20)\d\d)")
_BLOCK = re.compile(r"\n[ \t\r]*\n")


def _profiles(added: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, source in zip(b["text"], b["source"]):
                body = strip_added(text, added) if text else ""
                above, _, line = body.rstrip(_BLANKS).rpartition("\n")
                line = "" if _ends_sentence(above, line) else _line(line.strip())
                whole = text if text and body == text.rstrip() else body
                rows.append((source or "", line, len(whole), len(whole.encode()), _digest(whole)))
            yield pd.DataFrame(rows, columns=["s", "line", "c", "b", "same"])

    return run


def _line(line: str) -> str:
    """A line with digits as 9, by a hash if it is long."""
    line = re.sub(r"[0-9]+", "9", line)
    return line if len(line) <= LINE else f"#{xxhash.xxh3_128_hexdigest(line)}"


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _ends_sentence(above: str, line: str) -> bool:
    """Whether a last line with digits ends a sentence of the line directly above, as where lines are wrapped.

    Such an end says nothing of its source, as all digits count as the same.
    """
    above = above.rstrip(" \t\r")
    return line.rstrip()[-1:] in _TERMINAL and bool(re.search("[0-9]", line)) and above[-1:] not in ("", "\n") and above.rstrip(_CLOSERS)[-1:] not in _TERMINAL


def profile(ws: Workspace, documents: DataFrame, text: str, source: str, added: frozenset[str] = frozenset(), name: str = "profile") -> DataFrame:
    """One small row per text without the lines of `added` at its end: source, last line (digits as 9; a hash if long), characters, bytes and a hash.

    A text that ends with no such line keeps the blanks at its end in these figures.
    """
    rows = documents.select(F.col(text).alias("text"), F.col(source).alias("source"))
    return ws.write(rows.mapInPandas(_profiles(added), "s string, line string, c int, b int, same long"), name)


def added_lines(rows: DataFrame) -> list[str]:
    """Last lines that single sources add to their texts, of the rows of `profile`.

    A decision's own closing formulas come from all sources alike. A line is a
    source's if the sources that use it at most a tenth as often as all do hold
    a fifth of all texts or more, where at least 12 would be expected. Counted
    over all texts; each line makes up 0.2 % of some source's texts or more,
    so there are at most 500 per source.

    Where a source adds lines, its formulas aren't last. So the lines that the
    fewest texts' sources use are judged first, and the others are judged once
    more without the texts that end with one found.
    """
    counts = rows.groupBy("s", "line").agg(F.count("*").alias("n"))
    sizes = {r.s: r.n for r in counts.groupBy("s").agg(F.sum("n").alias("n")).collect()}
    total = sum(sizes.values())
    used = counts.filter("line <> ''").join(rows.groupBy("s").agg(F.count("*").alias("size")), "s")
    lines = used.groupBy("line").agg(F.sum("n").alias("all"), F.max(F.col("n") / F.col("size")).alias("share"))
    known: dict[str, dict[str, int]] = {}
    for r in used.join(lines.filter("all >= 12 and share >= 0.002"), "line").select("s", "line", "n").collect():
        known.setdefault(r.line, {})[r.s] = r.n

    def held(line: str, sizes: dict[str, int], total: int) -> float:
        """The share of the texts whose sources use the line often."""
        everywhere = sum(known[line].values()) / total
        return sum(sizes[s] for s, n in known[line].items() if n > 0.1 * everywhere * sizes[s]) / total

    def special(line: str) -> bool:
        rare = 1 - held(line, sizes, total)
        return rare >= 0.2 and rare * sum(known[line].values()) >= 12

    found = []
    for _, group in itertools.groupby(sorted((held(line, sizes, total), line) for line in known if special(line)), lambda x: x[0]):
        new = [line for _, line in group if special(line)]
        found += new
        for line in new:
            for s, n in known[line].items():
                sizes[s], total = sizes[s] - n, total - n
        if not total:
            break
    return sorted(found)


def bodies(ws: Workspace, documents: DataFrame, text: str, source: str) -> tuple[DataFrame, frozenset[str]]:
    """The `profile` of all texts without the lines that their sources add, and those lines.

    A source may add any number of lines below each other: the lines found are
    taken off and the last lines of what is left are counted again, until no
    more are found.
    """
    added, turn = frozenset(), 0
    while True:
        rows = profile(ws, documents, text, source, added, f"profile-{turn}")
        found = frozenset(added_lines(rows)) - added
        if not found:
            return rows, added
        added, turn = added | found, turn + 1
        ws.drop(f"profile-{turn - 1}")


def length_limits(rows: DataFrame) -> dict[str, list[tuple[str, int]]]:
    """source -> (unit, length) at which its texts pile up, in characters ('c') or bytes ('b'), of the rows of `bodies`.

    Repeated texts count once. A length counts if it has at least 5 texts and 1 % of its source's, and ten
    times as many as lengths nearby have on average. So there are at most 100 per source and unit. As blanks
    at a cut are trimmed, three lengths in a row count together too, as the last of them, where none of the
    lengths around counts on its own; they add at most 300.
    """
    rows = rows.filter("b > 0").select("s", "c", "b", "same").distinct()
    sizes = rows.groupBy("s").agg(F.count("*").alias("size"))
    long = rows.select("s", F.explode(F.create_map(F.lit("c"), "c", F.lit("b"), "b")).alias("unit", "length"))
    counts = long.groupBy("s", "unit", "length").agg(F.count("*").alias("n")).withColumn("bucket", F.floor(F.col("length") / 100))
    near = counts.groupBy("s", "unit", "bucket").agg(F.sum("n").alias("near"))
    ends = counts.select("s", "unit", "length", "n", "bucket", F.explode(F.array(*map(F.lit, range(3)))).alias("more")).withColumn("end", F.col("length") + F.col("more"))
    own = F.floor(F.col("end") / 100) == F.col("bucket")
    ends = ends.groupBy("s", "unit", "end").agg(
        F.sum(F.when(F.col("more") == 0, F.col("n"))).alias("n"),
        F.sum("n").alias("three"),
        F.sum(F.when(own, F.col("n"))).alias("inside"),
    )
    often = lambda n: (F.col(n) >= 5) & (F.col(n) >= 0.01 * F.col("size"))
    ends = ends.filter("n is not null").withColumn("bucket", F.floor(F.col("end") / 100)).join(sizes, "s").filter(often("three")).join(near, ["s", "unit", "bucket"])
    alone = often("n") & (F.col("n") * 100 >= 10 * (F.col("near") - F.col("n")))
    together = F.col("three") * 100 >= 30 * (F.col("near") - F.col("inside"))
    found: dict[tuple[str, str], list] = {}
    for r in ends.filter(alone | together).select("s", "unit", "end", "three", alone.alias("alone")).collect():
        found.setdefault((r.s, r.unit), []).append((not r.alone, -r.three, r.end))
    limits: dict[str, list[tuple[str, int]]] = {}
    for (s, unit), peaks in found.items():
        taken: set[int] = set()
        for other, _, end in sorted(peaks):
            if not other or not taken.intersection(range(end - 2, end + 3)):
                taken.add(end)
        limits.setdefault(s, []).extend((unit, end) for end in taken)
    return {s: sorted(x) for s, x in limits.items()}


def _without_line(text: str) -> tuple[str, str]:
    """The text before its last line, and that line as `_line` has it."""
    head, _, line = text.rpartition("\n")
    return head.rstrip(), _line(line.strip().rstrip("\x00"))


def strip_added(text: str, added: frozenset[str]) -> str:
    """The text without what a source adds after it, however many lines, and without blanks at its end."""
    text = text.rstrip()
    while text:
        head, line = _without_line(text)
        if line not in added:
            break
        text = head
    return text


def _kind(c: str) -> str:
    if c in "….":
        return c
    if c in _TERMINAL:
        return "T"
    if c in _CLOSERS:
        return "C"
    if c in ",;:":
        return ","
    if c.isdigit():
        return "9"
    if c.isalpha():
        return "A" if c.isupper() else "a"
    return " " if c.isspace() else "0" if c == "\x00" else "-"


def _bucket(n: int) -> int:
    return n.bit_length()


def _last_block(text: str) -> str:
    """What follows the last blank line, looked for in more and more of the text from its end."""
    size = 3000
    while True:
        tail, start = text[-size:], 0
        for m in _BLOCK.finditer(tail):
            start = m.end()
        if start or size >= len(text):
            return tail[start:].strip()
        size *= 4


def features(text: str, at_limit: bool) -> np.ndarray:
    """Places of a stripped text's features: its closing characters, last block and last words, and whether its length is a limit."""
    had_nul = text.endswith("\x00")
    text = text.rstrip("\x00").rstrip()
    block = _last_block(text)
    line = block.rpartition("\n")[2].strip()
    marked = _MARKER.match(block)
    flat = re.sub(r"\d+", "9", " ".join(block[marked.end() if marked else 0 :].split()))
    words = flat.split(" ")
    kinds = "".join(_kind(c) for c in text[-4:])
    closed = text.rstrip(_CLOSERS)[-1:]
    done = bool(closed) and closed in _TERMINAL and not text.endswith(("...", "…"))
    dots = len(text) - len(text.rstrip("."))
    sentences = bool(re.search(r"[a-zà-ÿ)][.!?] [A-ZÀ-ÖØ-Þ]", flat))
    size = _bucket(len(block))
    last = words[-1] if words else ""
    plain_line = re.sub(r"\d+", "9", line)
    f = [
        "bias",
        f"k1 {kinds[-1:]}",
        f"k2 {kinds[-2:]}",
        f"k3 {kinds[-3:]}",
        f"done {done} {dots if dots < 4 else 4}",
        f"size {size} {done}",
        f"lines {min(block.count(chr(10)), 3)} {done}",
        f"marked {bool(marked)} {done} {size}",
        f"sentences {sentences} {done} {bool(marked)}",
        f"line {plain_line}",
        f"first {words[0] if words else ''} {done}",
        f"two {' '.join(words[:2])} {done}",
        f"three {' '.join(words[:3])}",
        f"shape {re.sub('[a-zà-ÿ]+', 'a', re.sub('[A-ZÀ-ÖØ-Þ]', 'A', last))} {done} {size > 7}",
        f"last {last}",
        f"last two {' '.join(words[-2:])}",
        f"end {text[-3:]}",
        f"names {all(w[:1].isupper() for w in words)} {'  ' in line} {size} {done}",
        f"limit {at_limit}",
        f"limit {at_limit} {done}",
        f"limit {at_limit} {kinds[-1:]}",
        f"nul {had_nul}",
        f"number end {last.rstrip('.,')[-1:] == '9'} {size > 7} {done}",
    ]
    return np.array([xxhash.xxh32_intdigest(x) % WIDTH for x in f], "int32")


def artificial_cut(text: str, rng: random.Random) -> str | None:
    """A copy of an intact text that ends inside a word or sentence, in one of the ways fields get cut; None if it is too short."""
    if len(text) < 60:
        return None
    at = rng.randrange(30, len(text) - 2)
    way = rng.random()
    if way < 0.15:
        at = text.rfind(" ", 0, at)  # before a word
    elif way < 0.25:
        at = text.rfind(",", 0, at) + 1
    elif way < 0.33:  # after the full stop of an abbreviation
        stops = [m.start() + 1 for m in _INNER_STOP.finditer(text)]
        at = rng.choice(stops) if stops else at
    head = text[: max(at, 0)].rstrip()
    following = text[len(head) :]
    goes_on = following.startswith(" ") and (following[1:2].islower() or following[1:2].isdigit())
    if len(head) < 20 or head.rstrip(_CLOSERS)[-1:] in _TERMINAL and following[:1].isspace() and not goes_on:
        return None  # by chance the end of a sentence
    if text[len(head) :].lstrip(" \t\r")[:1] == "\n" and text[len(head) :].count("\n", 0, 4) > 1:
        return None  # of a block
    way = rng.random()
    if way < 0.2:
        return head + rng.choice(["...", "…"])
    if way < 0.35:  # what a broken transfer leaves
        return head + rng.choice(["\x00" * rng.randint(1, 4), "\ufffd", rng.choice(["&amp;", "&quot;", "&nbsp;", "&lt;"])[: rng.randint(1, 4)]])
    return head


def _at_limit(text: str, body: str, marks: list[tuple[str, int]] | None) -> bool:
    """Whether a text, or its body if the source adds lines after it, has a length of `marks`."""
    if not marks:
        return False
    if body != text.rstrip():
        text = body
    own = {"c": len(text), "b": len(text.encode())}
    # A limit in bytes may fall inside a character, and one may be reached after blanks were trimmed.
    return any(0 <= length - own[unit] <= (3 if unit == "b" else 2) for unit, length in marks)


def _examples(added: frozenset[str], limits: dict[str, list[tuple[str, int]]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, text, source in zip(b["key"], b["text"], b["source"]):
                if not text or not text.strip():
                    continue
                intact = strip_added(text, added)
                if not intact or _at_limit(text, intact, limits.get(source or "")):
                    continue
                rng = random.Random(xxhash.xxh64_intdigest(str(key)))
                out.append((0, features(intact, False).tolist()))
                cut = artificial_cut(intact, rng)
                if cut:
                    out.append((1, features(cut, rng.random() < LIMITED).tolist()))
            yield pd.DataFrame(out, columns=["label", "features"])

    return run


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-5) -> np.ndarray:
    """Weights of a logistic regression over hashed features (rows of places), by full-batch Adagrad."""
    w, g2 = np.zeros(WIDTH), np.full(WIDTH, 1e-8)
    often = np.bincount(x.ravel(), minlength=WIDTH) >= OFTEN
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    flat = x.ravel()
    for _ in range(EPOCHS):
        p = 1 / (1 + np.exp(-np.clip(w[x].sum(1), -30, 30)))
        g = np.bincount(flat, np.repeat((p - y) * share, x.shape[1]), WIDTH) + penalty * w
        g[~often] = 0
        g2 += g * g
        w -= 0.5 * g / np.sqrt(g2)
    return w


def train(documents: DataFrame, n: int, key: str, text: str, source: str, added: frozenset[str], limits: dict, sample: int = SAMPLE) -> np.ndarray:
    """Weights fitted on a bounded sample of texts and their artificial cuts.

    Texts at a length limit aren't taken. Two first fits, each on half of the
    examples, take the others for intact; what the fit on the other half finds
    cut is left out of the last fit.
    """
    part = min(1.0, sample / max(n, 1))
    chosen = documents.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(part * (1 << 30)))
    rows = chosen.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(source).alias("source"))
    examples = rows.mapInPandas(_examples(added, limits), "label int, features array<int>").toPandas()
    if not len(examples) or examples["label"].nunique() < 2:
        return np.zeros(WIDTH)
    x, y = np.array(examples["features"].tolist()), examples["label"].to_numpy()
    half = np.arange(len(y)) % 4 < 2  # an intact text and its cut mostly stay together
    cut = np.empty(len(y), bool)
    for own in (half, ~half):
        cut[own] = fit(x[~own], y[~own])[x[own]].sum(1) > 0 if own.any() and len(set(y[~own])) == 2 else False
    sound = (y == 1) | ~cut
    return fit(x[sound], y[sound]) if (y[sound] == 0).any() else fit(x, y)


def _score(added: frozenset[str], limits: dict[str, list[tuple[str, int]]], weights: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            scores = []
            for text, source in zip(b["text"], b["source"]):
                body = strip_added(text, added) if text else ""
                scores.append(float(weights[features(body, _at_limit(text, body, limits.get(source or "")))].sum()) if body.strip("\x00 \n") else -30.0)
            yield pd.DataFrame({"key": b["key"], "source": b["source"], "margin": scores})

    return run


def scored(ws: Workspace, documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", sample: int = SAMPLE) -> DataFrame:
    """(key, source, margin) of every row; a margin above 0 means that its text was cut off.

    Null, empty and blank texts aren't cut. A null source is one source. Texts
    are judged by their length and their end, both without lines that the
    source adds. An empty table, or one without texts to learn from, has no cuts.
    """
    profiles, added = bodies(ws, documents, text, source)
    limits = length_limits(profiles)
    weights = train(documents, profiles.count(), key, text, source, added, limits, sample).astype("float32")
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(source).alias("source"))
    kind = documents.schema[key].dataType.simpleString()
    return rows.mapInPandas(_score(added, limits, weights), f"key {kind}, source string, margin double").withColumnRenamed("key", key)
