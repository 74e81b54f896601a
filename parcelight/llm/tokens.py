"""Token ids of a whole corpus: content-defined chunks are encoded once, joins are repaired."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.runtime import ship, stored_bytes

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k"

#: Fixed value: how the vocabularies of this kind split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes that the rolling hash sees, bits of it that must be zero at a cut, and the bytes after which a chunk is cut anywhere.
WINDOW, CUT_BITS, LONGEST = 32, 5, 4096
#: Bytes that are hashed at once, tokens of texts put together at once, bytes of text in a block, bytes of stored input per task of a shuffle, and tokens of chunks that an encoding task remembers.
SLICE, TOKENS, BLOCK, TASK, REMEMBERED = 4 << 20, 1 << 20, 1 << 18, 8 << 20, 1 << 26
#: Most tasks of a shuffle.
MOST_TASKS = 1 << 17

_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], dtype="uint32")
_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True


@functools.lru_cache(maxsize=4)
def _vocabulary(folder: str, name: str) -> dict[bytes, int]:
    with open(f"{folder}/{name}.tiktoken") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(str.split, f)}


@functools.lru_cache(maxsize=4)
def encoder(folder: str, name: str):
    """The tokenizer; kept by the worker process. Strings of special tokens are ordinary text."""
    import tiktoken

    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=_vocabulary(folder, name), special_tokens={})


@functools.lru_cache(maxsize=4)
def _edges(folder: str, name: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Whether a token ends graphic, whether it begins blank, and its bytes, by id."""
    ranks = _vocabulary(folder, name)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return np.array([bool(t) and bool(_GRAPHIC[t[-1]]) for t in tokens]), np.array([bool(t) and bool(_BLANK[t[0]]) for t in tokens]), tokens


def _id_type(folder: str, name: str) -> str:
    return "<u4" if max(_vocabulary(folder, name).values()) >= 1 << 16 else "<u2"


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash of the WINDOW bytes up to each byte: the sum of table[byte] << age."""
    h = _GEAR[data]
    step = 1
    while step < WINDOW:
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint32(step)
        h = h + older
        step *= 2
    return h


def chunk_starts(data: np.ndarray, offsets: np.ndarray, longest: int | None = LONGEST) -> np.ndarray:
    """Where the chunks of consecutive texts (text i is data[offsets[i]:offsets[i + 1]]) begin.

    A cut needs a blank after a graphic ASCII character, which the tokenizer
    always splits at, and zero bits in the rolling hash of the bytes before it,
    all of the same text. So it depends on the text's own bytes only. Where
    none comes for `longest` bytes, the text is cut between any two characters.
    """
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        fits = (rolling_hash(data)[:-1] >> np.uint32(32 - CUT_BITS)) == 0
        cut[1:-1] = fits & _GRAPHIC[data[:-1]] & _BLANK[data[1:]]
        for i in range(WINDOW):
            near = offsets[:-1] + i
            cut[near[near < offsets[1:]]] = False
    cut[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    if longest is None:
        return starts
    lengths = np.diff(np.append(starts, len(data)))
    extra = []
    for s, n in zip(starts[lengths > longest].tolist(), lengths[lengths > longest].tolist()):
        for p in range(s + longest, s + n, longest):
            while data[p] & 0xC0 == 0x80:
                p -= 1
            extra.append(p)
    return np.sort(np.concatenate([starts, np.array(extra, "int64")])) if extra else starts


def _slices(array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of a text column; nulls are empty."""
    array = array.cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], "int64")[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", "uint8")
    start = 0
    while start < len(array):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE, "right")) - 1)
        yield start, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


class _Cutter:
    """The chunks of one task's texts, numbered in the order in which they first occur."""

    def __init__(self, longest: int | None):
        self.longest, self.numbers = longest, {}

    def cut(self, array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[tuple[int, bytes, bytes]]]]:
        """(rows, chunks per row, number of each chunk, new chunks as (number, digest, text)) of runs of rows."""
        for _, data, offsets in _slices(array):
            starts = chunk_starts(data, offsets, self.longest)
            ends = np.append(starts[1:], len(data))[: len(starts)]
            row = np.searchsorted(offsets, starts, "right") - 1
            raw = data.tobytes()
            numbers, new = np.empty(len(starts), "int32"), []
            for i, (a, e) in enumerate(zip(starts.tolist(), ends.tolist())):
                text = raw[a:e]
                digest = xxhash.xxh3_128_digest(text)
                n = self.numbers.get(digest)
                if n is None:
                    n = self.numbers[digest] = len(self.numbers)
                    new.append((n, digest, text))
                numbers[i] = n
            yield len(offsets) - 1, np.bincount(row, minlength=len(offsets) - 1), numbers, new


def _packed(*arrays: np.ndarray | bytes) -> bytes:
    return zstandard.compress(b"".join(a if isinstance(a, bytes) else a.tobytes() for a in arrays), 3)


def _rows(kind: pa.DataType) -> pa.Schema:
    """Rows between the stages: a block of chunks (bucket, split, n, block) or the recipe of a text (split, key, chunks), which has no n."""
    return pa.schema([("bucket", pa.int32()), ("split", pa.int32()), ("n", pa.int32()), ("block", pa.binary()), ("key", kind), ("chunks", pa.list_(pa.int32()))])


def _blocks(found: list[tuple[int, int, int, bytes]], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*found), schema)]
    return pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(found), f.type) for f in list(schema)[4:])], schema=schema)


def _cut(buckets: int, longest: int | None):
    """Asks for each chunk of the task once, in blocks of (digest, text) by bucket of the digest, and gives the recipe of each row.

    A chunk's number is its place among the digests of the task, so it depends
    on the task's rows alone, not on their order.
    """

    def block(bucket: int, split: int, chunks: list[tuple[int, bytes, bytes]]) -> tuple[int, int, int, bytes]:
        _, digests, texts = zip(*chunks)
        return bucket, split, len(chunks), _packed(np.array([len(t) for t in texts], "<i4"), b"".join(digests), b"".join(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, cutter, schema = 0, _Cutter(longest), None
        waiting: dict[int, list] = {}
        held: dict[int, int] = {}
        recipes: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        for b in batches:
            if not len(b):
                continue
            split, full = b.column(0)[0].as_py(), []
            schema = schema or _rows(b.column(1).type)
            done = 0
            for rows, counts, numbers, new in cutter.cut(b.column(2)):
                recipes.append((b.column(1).slice(done, rows), counts, numbers))
                done += rows
                for chunk in new:
                    at = int.from_bytes(chunk[1][:4], "little") % buckets
                    waiting.setdefault(at, []).append(chunk)
                    held[at] = held.get(at, 0) + len(chunk[2])
                    if held[at] >= BLOCK:
                        full.append(block(at, split, waiting.pop(at)))
                        del held[at]
            if full:
                yield _blocks(full, schema)
        if waiting:
            yield _blocks([block(at, split, chunks) for at, chunks in waiting.items()], schema)
        ranks = np.empty(len(cutter.numbers), "int32")
        ranks[np.argsort(np.array(list(cutter.numbers), "S16"))] = np.arange(len(ranks), dtype="int32")
        for keys, counts, numbers in recipes:
            n = len(keys)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype("int32")), pa.array(ranks[numbers]))
            fixed = [pa.array(np.full(n, split % buckets, "int32")), pa.array(np.full(n, split, "int32")), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([*fixed, keys, lists], schema=schema)

    return run


def _encode(folder: str, name: str, count_only: bool):
    """Encodes each chunk of a bucket once and answers every block that asked for it with (digest, ids); recipes pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(folder, name).encode_ordinary
        wide = _id_type(folder, name)
        known, held = {}, 0
        for b in batches:
            asked = b.column(2).is_valid()
            recipes = b.filter(pc.invert(asked))
            if len(recipes):
                yield recipes
            out = []
            for at, split, n, block in zip(*(c.to_pylist() for c in b.filter(asked).columns[:4])):
                raw = zstandard.decompress(block)
                ends = (np.cumsum(np.frombuffer(raw, "<i4", n)) + 20 * n).tolist()
                digests, ids, start = raw[4 * n : 20 * n], [], 20 * n
                for i, end in enumerate(ends):
                    digest = digests[16 * i : 16 * i + 16]
                    found = known.get(digest)
                    if found is None:
                        tokens = encode(raw[start:end].decode())
                        if held > REMEMBERED:  # what is forgotten is encoded again, with the same result
                            known, held = {}, 0
                        found = known[digest] = len(tokens) if count_only else np.array(tokens, wide)
                        held += 1 if count_only else len(tokens)
                    ids.append(found)
                    start = end
                sizes = np.array(ids if count_only else [len(x) for x in ids], "<i4")
                out.append((at, split, n, _packed(sizes, digests, b"" if count_only else np.concatenate(ids))))
            if out:
                yield _blocks(out, b.schema)

    return run


def repair(ids: list[int], joins: list[int], folder: str, name: str) -> list[int]:
    """ids of a text whose chunks meet before the positions `joins`, as if it had been encoded whole.

    Around a join the text is encoded again, between the nearest places on
    either side where a graphic character meets a blank. The tokenizer always
    splits there, so what lies outside agrees with the whole text's encoding.
    """
    graphic, blank, tokens = _edges(folder, name)
    out: list[int] = []
    done = 0
    for j in joins:
        if j < done:
            continue
        a, b = j - 1, j + 1
        while a > done and not (graphic[ids[a - 1]] and blank[ids[a]]):
            a -= 1
        while b < len(ids) and not (graphic[ids[b - 1]] and blank[ids[b]]):
            b += 1
        if a < done:
            a = done
        out += ids[done:a]
        out += encoder(folder, name).encode_ordinary(b"".join(tokens[i] for i in ids[a:b]).decode())
        done = b
    return out + ids[done:]


class _Answers:
    """Token ids (or only their number) of a split's chunks, by the chunks' numbers."""

    def __init__(self, blocks: list[tuple[int, bytes]], wide: str):
        sizes, digests, tokens = [], [], []
        for n, block in blocks:
            raw = zstandard.decompress(block)
            sizes.append(np.frombuffer(raw, "<i4", n))
            digests.append(np.frombuffer(raw, "S16", n, 4 * n))
            tokens.append(np.frombuffer(raw, wide, -1, 20 * n))
        size = np.concatenate(sizes).astype("int64") if sizes else np.zeros(0, "int64")
        order = np.argsort(np.concatenate(digests)) if digests else np.zeros(0, "int64")
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, wide)
        self.sizes, self.starts = size[order], (np.cumsum(size) - size)[order]


def _texts_ids(answers: _Answers, counts: np.ndarray, chunks: np.ndarray, folder: str, name: str) -> pa.Array:
    """The ids of rows of `counts` chunks each."""
    graphic, blank, _ = _edges(folder, name)
    sizes = answers.sizes[chunks]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    tokens = answers.tokens[np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(answers.starts[chunks], sizes)]
    bounds = np.append(0, np.cumsum(counts))
    text_starts = np.append(ends - sizes, total)[bounds]
    inner = np.ones(len(chunks), bool)
    inner[bounds[:-1][counts > 0]] = False
    at = (ends - sizes)[inner]
    doubtful = at[~(graphic[tokens[at - 1]] & blank[tokens[at]])]
    if not len(doubtful):
        return pa.ListArray.from_arrays(pa.array(text_starts.astype("int32")), pa.array(tokens.astype("int32")))
    texts = [tokens[a:b].tolist() for a, b in zip(text_starts[:-1].tolist(), text_starts[1:].tolist())]
    owner = np.searchsorted(text_starts, doubtful, "right") - 1
    for t in np.unique(owner).tolist():
        texts[t] = repair(texts[t], (doubtful[owner == t] - text_starts[t]).tolist(), folder, name)
    return pa.array(texts, pa.list_(pa.int32()))


def _assemble(folder: str, name: str, count_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, blocks, answers = None, [], None
        wide = _id_type(folder, name)
        for b in batches:
            splits = b.column(0).to_numpy()
            is_answer = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(splits) != 0) | (np.diff(is_answer.astype("int8")) != 0)) + 1
            for start, stop in zip(np.append(0, change).tolist(), np.append(change, len(b)).tolist()):
                if start == stop:
                    continue
                if splits[start] != split:
                    split, blocks, answers = splits[start], [], None
                part = b.slice(start, stop - start)
                if is_answer[start]:
                    blocks += zip(part.column(1).to_pylist(), part.column(2).to_pylist())
                    continue
                if answers is None:
                    answers, blocks = _Answers(blocks, wide), []
                lists = part.column(4)
                offsets = np.asarray(lists.offsets)
                chunks, counts = np.asarray(lists.flatten()), np.diff(offsets)
                first = np.append(0, np.cumsum(counts))
                size = np.append(0, np.cumsum(answers.sizes[chunks]))[first]
                if count_only:
                    yield pa.RecordBatch.from_arrays([part.column(3), pa.array(np.diff(size))], ["key", "n"])
                    continue
                row = 0
                while row < len(part):
                    end = max(row + 1, int(np.searchsorted(size, size[row] + TOKENS, "right")) - 1)
                    ids = _texts_ids(answers, counts[row:end], chunks[first[row] : first[end]], folder, name)
                    yield pa.RecordBatch.from_arrays([part.column(3).slice(row, end - row), ids], ["key", "ids"])
                    row = end

    return run


def _tasks(documents: DataFrame) -> int:
    """Tasks of a shuffle, by the stored size of what is read."""
    size = stored_bytes(documents)
    least = documents.sparkSession.sparkContext.defaultParallelism
    return least if size is None else min(MOST_TASKS, max(least, -(-size // TASK)))


def _encoded(documents: DataFrame, key: str, text: str, folder: str, name: str, count_only: bool) -> DataFrame:
    ship(documents.sparkSession)
    tasks = _tasks(documents)
    rows = documents.select(F.spark_partition_id().alias("split"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"bucket int, split int, n int, block binary, key {kind}, chunks array<int>"
    asked = rows.mapInArrow(_cut(tasks, None if count_only else LONGEST), schema)
    answered = asked.repartitionById(tasks, F.col("bucket")).mapInArrow(_encode(folder, name, count_only), schema).drop("bucket")
    together = answered.repartitionById(tasks, F.col("split") % tasks).sortWithinPartitions("split", F.col("n").isNull())
    return together.mapInArrow(_assemble(folder, name, count_only), f"key {kind}, " + ("n long" if count_only else "ids array<int>")).withColumnRenamed("key", key)


def token_ids(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """(key, ids): the token ids of each row's text, without special tokens.

    A null and an empty text give an empty list. Rows with the same or a null
    key stay apart, each with its own ids.

    Texts are read once and cut into content-defined chunks. Each reading task
    asks for each of its chunks once, in compressed blocks by the chunk's
    digest; where the requests meet, a chunk is encoded once, wherever it
    occurs, and every task that asked gets the ids back. So a chunk that a
    large part of all rows share costs a request per task, not per row. The
    answers meet the task's recipes, the chunk numbers of its rows, and joins
    at which the tokenizer might not split are encoded again. Any input will
    do, also one whose rows come in another order when a lost task is repeated.
    """
    return _encoded(documents, key, text, folder, name, False)


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """(key, n): the number of token ids of each row's text, as of token_ids; null and empty texts have 0.

    Chunks end only where the tokenizer always splits, so their numbers add up.
    """
    return _encoded(documents, key, text, folder, name, True)
