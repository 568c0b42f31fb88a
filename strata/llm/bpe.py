"""BPE encoding and decoding of whole texts with a public tokenizer file.

Texts are split into words in Spark tasks. A block (a few thousand texts) keeps its texts as numbers into the list of
its distinct words; only that list is shuffled, to the shards of the word table, where each distinct word is encoded
once. The ids come back to the block and are joined to the words' positions. So a word that fills a third of a corpus
is one entry per block, and a shard holds distinct words only. Ids are decoded through the table from ids to pieces,
which is as large as the vocabulary and goes to every task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm.textblocks import blocks, release

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A block holds about so many bytes of text, and whole texts only.
BLOCK_BYTES = 3 << 20
_SLICE_BYTES = 1 << 18
_ENCODED_AT_ONCE = 2_000
_IDS_AT_ONCE = 1 << 18
# Below this character, texts are normalised by lower-casing alone and Python's tables agree with the tokenizer's.
_SIMPLE = 0x300


class Parts(NamedTuple):
    """How to split texts into words: made from the text of a tokenizer's file, which executors need not have."""

    special: re.Pattern | None
    fast: re.Pattern
    beyond: re.Pattern


_made: dict = {}


def _tokenizer(text: str):
    """The tokenizer, made once in each task that needs it."""
    if text not in _made:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _made[text] = Tokenizer.from_str(text)
        _made[text].no_truncation()
        _made[text].no_padding()
    return _made[text]


def parts_of(text: str) -> Parts:
    made = json.loads(text)
    steps = made["pre_tokenizer"]["pretokenizers"]
    plain = all(not t[k] for t in made["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if (made["model"]["type"] != "BPE" or made["post_processor"] or made["decoder"] or not plain
            or [s["type"] for s in made["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]
            or steps[0]["type"] != "Split" or not steps[0]["invert"] or steps[0]["behavior"] != "Removed"
            or [s["type"] for s in steps[1:]] != ["ByteLevel"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]):
        raise ValueError("only tokenizers that split lower-case text into words are supported")
    chars = [chr(c) for c in range(_SIMPLE)]
    kinds = {r"\p{L}": [c for c in chars if unicodedata.category(c)[0] == "L"],
             r"\p{N}": [c for c in chars if unicodedata.category(c)[0] == "N"],
             r"\s": [c for c in chars if c.isspace() and not "\x1c" <= c <= "\x1f"]}
    pattern = steps[0]["pattern"]["Regex"]
    for name, members in kinds.items():
        pattern = pattern.replace(name, "".join(map(re.escape, members)))
    special = sorted((t["content"] for t in made["added_tokens"]), key=len, reverse=True)
    return Parts(re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None,
                 re.compile(pattern), re.compile(f"[^\\x00-{chr(_SIMPLE - 1)}]"))


def split_words(parts: Parts, file: str, text: str) -> list[str]:
    """Words of a text as the tokenizer sees them; the strings of special tokens are words of their own."""
    out: list[str] = []
    for i, piece in enumerate(parts.special.split(text) if parts.special else [text]):
        if i % 2:
            out.append(piece)
        elif not parts.beyond.search(piece):
            out += parts.fast.findall(piece.lower())
        else:
            tokenizer = _tokenizer(file)
            plain = tokenizer.normalizer.normalize_str(piece)
            at = [span for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
            out += [plain[a:b] for a, b in at]
    return out


def _squeeze(codes: np.ndarray) -> bytes:
    """Compressed unsigned numbers: lowest bytes first, then the higher ones, which mostly are zero."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _shard(word: str, shards: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % shards


class _Block:
    """Distinct words and numbered texts of consecutive rows."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.ids: list = []
        self.counts: list[int] = []
        self.codes: list[np.ndarray] = []
        self.bytes = 0
        self.digest = hashlib.blake2b(digest_size=16)

    def add(self, parts: Parts, file: str, rows: pa.RecordBatch) -> None:
        self.ids += rows.column(0).to_pylist()
        self.bytes += rows.column(1).nbytes
        for key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            self.digest.update(repr(key).encode() + b"\0" + (text or "").encode("utf-8", "surrogatepass") + b"\0")
            words = split_words(parts, file, text) if text else []
            self.counts.append(len(words))
            self.codes.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))

    def by_shard(self, shards: int) -> tuple[list[list[str]], np.ndarray]:
        """Words of each shard, and the number that each word gets when shards stand one after the other."""
        lists: list[list[str]] = [[] for _ in range(shards)]
        codes: list[list[int]] = [[] for _ in range(shards)]
        for word, number in self.numbers.items():
            s = _shard(word, shards)
            lists[s].append(word)
            codes[s].append(number)
        place = np.empty(len(self.numbers), np.uint32)
        place[np.fromiter((c for cs in codes for c in cs), np.int64, len(place))] = np.arange(len(place), dtype=np.uint32)
        return lists, place


def _each_block(parts: Parts, text: str, batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    block = _Block()
    for batch in batches:
        for rows in blocks(batch, batch.schema.names[1], _SLICE_BYTES):
            block.add(parts, text, rows)
            if block.bytes >= BLOCK_BYTES:
                yield block
                block = _Block()
    if block.ids:
        yield block


def _words(parts: Parts, text: str, shards: int) -> Callable:
    """Rows (block, shard, words) of the distinct words of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(parts, text, batches):
            lists, _ = block.by_shard(shards)
            packed = [(s, zstandard.ZstdCompressor(level=3).compress("\n".join(ws).encode("utf-8", "surrogatepass")))
                      for s, ws in enumerate(lists) if ws]
            name = block.digest.hexdigest()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(packed)), pa.array([s for s, _ in packed], pa.int32()),
                 pa.array([w for _, w in packed], pa.binary())], ["block", "shard", "words"])

    return run


def _texts(parts: Parts, text: str, shards: int, key_type: pa.DataType) -> Callable:
    """Rows (block, ids, counts, codes) with the texts of each block as numbers of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(parts, text, batches):
            _, place = block.by_shard(shards)
            codes = np.concatenate(block.codes) if block.codes else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.digest.hexdigest()]), pa.array([block.ids], pa.list_(key_type)),
                 pa.array([_squeeze(np.array(block.counts, np.uint32))], pa.binary()),
                 pa.array([_squeeze(place[codes])], pa.binary())], ["block", "keys", "counts", "codes"])

    return run


def _encode_shard(text: str) -> Callable:
    """Encodes each distinct word of a shard once and answers every block: rows (block, shard, sizes, ids)."""

    def run(rows: pa.Table) -> pa.Table:
        tokenizer = _tokenizer(text)
        rows = rows.take(pa.array(np.sort(np.unique(rows.column("block").to_numpy(), return_index=True)[1])))
        lists = [zstandard.ZstdDecompressor().decompress(w).decode("utf-8", "surrogatepass").split("\n")
                 for w in rows.column("words").to_pylist()]
        words = sorted({w for ws in lists for w in ws})
        ids: list[list[int]] = []
        for a in range(0, len(words), _ENCODED_AT_ONCE):
            ids += [e.ids for e in tokenizer.encode_batch(words[a:a + _ENCODED_AT_ONCE], add_special_tokens=False)]
        table = dict(zip(words, ids))
        sizes, flat = [], []
        for ws in lists:
            mine = [table[w] for w in ws]
            sizes.append(_squeeze(np.fromiter(map(len, mine), np.uint32, len(mine))))
            flat.append(_squeeze(np.fromiter((i for m in mine for i in m), np.uint32)))
        del words, ids, table, lists
        release()
        return pa.table({"block": rows.column("block"), "shard": rows.column("shard"),
                         "sizes": pa.array(sizes, pa.binary()), "tokens": pa.array(flat, pa.binary())})

    return run


def _join_back(key_type: pa.DataType, names: list[str], pieces: list[str | None] | None) -> Callable:
    """Puts the ids of a block's words at the words' positions: rows (key, ids), and decoded texts if pieces are given.

    Texts are decoded here, so that a task has one Python worker and its ids don't travel to another one.
    """

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            raise RuntimeError("the input gave other rows when it was read again; encode a stored table")
        # Equal blocks share their name, so each of them has brought the same answers: one for each shard is enough.
        order = np.unique(answers.column("shard").to_numpy(), return_index=True)[1]
        at = [answers.column(c).to_pylist() for c in ("sizes", "tokens")]
        sizes = np.concatenate([_unsqueeze(at[0][i]) for i in order] or [np.zeros(0, np.uint32)]).astype(np.int64)
        tokens = np.concatenate([_unsqueeze(at[1][i]) for i in order] or [np.zeros(0, np.uint32)]).astype(np.int32)
        starts = np.cumsum(sizes) - sizes
        lookup = None if pieces is None else _piece_lookup(pieces)
        out = []
        for keys, counts, codes in zip(*(texts.column(c).to_pylist() for c in ("keys", "counts", "codes"))):
            codes, counts = _unsqueeze(codes), _unsqueeze(counts).astype(np.int64)
            n = sizes[codes]
            if len(codes) and codes.max() >= len(sizes):
                raise RuntimeError("the input gave other rows when it was read again; encode a stored table")
            ends = np.cumsum(n)
            flat = tokens[np.repeat(starts[codes] - (ends - n), n) + np.arange(n.sum())]
            cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32()))
            decoded = [] if lookup is None else [_decoded(lookup, lists)]
            out.append(pa.table([pa.array(keys, key_type), lists, *decoded], names=names))
        release()
        return pa.concat_tables(out)

    return run


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           decoded_col: str | None = None) -> DataFrame:
    """Rows ``id_col, ids`` with the ids of each whole text, one row for each row of ``docs``; with ``decoded_col`` also
    what ``decode`` gives for the ids.

    ``tokenizer`` is the path of a tokenizer file on the driver. Ids equal those of the tokenizers library without added
    special tokens, truncation and padding; strings of special tokens inside a text become these tokens. NULL and empty
    texts have no ids; repeated ids and texts stay apart, other columns are ignored, an empty table gives no rows. The
    input is read twice and must give the same rows in the same order, as a stored table does; other input raises.
    """
    with open(tokenizer, encoding="utf-8") as file:
        text = file.read()
    parts = parts_of(text)
    spark = docs.sparkSession
    shards = max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    key_type = to_arrow_type(kind)
    words = rows.mapInArrow(_words(parts, text, shards), "block string, shard int, words binary")
    answers = words.groupBy("shard").applyInArrow(
        _encode_shard(text), "block string, shard int, sizes binary, tokens binary")
    numbered = rows.mapInArrow(_texts(parts, text, shards, key_type), T.StructType([
        T.StructField("block", T.StringType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("counts", T.BinaryType()), T.StructField("codes", T.BinaryType())]))
    out = T.StructType([T.StructField(id_col, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded_col:
        out = out.add(decoded_col, T.StringType())
    return numbered.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _join_back(key_type, out.names, piece_table(tokenizer) if decoded_col else None), out)


def piece_table(tokenizer: str) -> list[str | None]:
    """The piece of each id."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer)
    return [made.id_to_token(i) for i in range(max(made.get_vocab().values()) + 1)]


def _piece_lookup(pieces: list[str | None]) -> pa.Array:
    """Pieces by id; the last entry is that of ids without one."""
    return pa.array([*pieces, None], pa.string())


def _decoded(lookup: pa.Array, column: pa.Array) -> pa.Array:
    """Texts of lists of ids, some of them at a time."""

    def texts(part: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy()
        ids = pc.fill_null(part.flatten(), -1).to_numpy()
        ids = np.where((ids >= 0) & (ids < len(lookup) - 1), ids, len(lookup) - 1)
        found = lookup.take(pa.array(ids))
        known = np.asarray(found.is_valid())
        ends = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found.drop_null()), " ")

    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    group = np.cumsum(sizes, dtype=np.int64) // _IDS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(column)]
    return pa.concat_arrays([texts(column.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])


def decode(rows: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All rows plus ``out_col``: the pieces of the ids with a space between them, as the library joins them.

    Special tokens stay. Ids outside the vocabulary and NULL ids have no piece and are left out, as by the library; a
    NULL list gives an empty text. ``out_col`` replaces a column of that name.
    """
    lookup = _piece_lookup(piece_table(tokenizer))

    def look_up(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield _decoded(lookup, column)

    look_up.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return rows.withColumn(out_col, F.arrow_udf(look_up, "string")(F.col(ids_col)))
