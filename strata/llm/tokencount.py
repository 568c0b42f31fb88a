"""Token counts that follow edits: a segment tree of pre-tokens for each document.

The leaves of a tree are runs of pre-tokens of about ``LEAF`` characters. They are cut where a space follows a character
that is none: no pre-token goes across such a place, and none of those before it depends on what comes behind it, so the
tokens of leaves add up to those of the text. Inner nodes hold sums of characters and tokens. An edit finds its leaves
by the characters, encodes them and as much of their neighbours as makes the cuts around them sound again, and corrects
the sums above them.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF = 512
_TREE = "struct<chars:array<int>,tokens:array<int>>"
_EDITED = "struct<text:string,chars:array<int>,tokens:array<int>,encoded:long>"
_made: dict = {}


def _counter(ranks: bytes, pattern: str) -> Callable[[str], int]:
    """Number of tokens of a string, by a rank file's text and the pattern that splits into pre-tokens."""
    key = (hashlib.sha256(ranks).digest(), pattern)
    if key not in _made:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        _made[key] = lambda text: len(encoding.encode_ordinary(text))
    return _made[key]


def _sound(text: str, at: int) -> bool:
    """Whether leaves may be cut here."""
    return at in (0, len(text)) or (text[at] == " " and not text[at - 1].isspace())


def _cuts(text: str, size: int) -> list[int]:
    """Ends of leaves of about ``size`` characters."""
    out, at = [], 0
    while len(text) - at > size:
        at = text.find(" ", at + size)
        while at > 0 and not _sound(text, at):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(at)
    return [*out, len(text)]


class Tree:
    """Sums over leaves: node 1 is the root, the children of ``i`` are ``2 i`` and ``2 i + 1``; node 0 is unused."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.chars, self.tokens = chars, tokens
        self.width = len(chars) // 2

    @classmethod
    def of(cls, text: str, count: Callable[[str], int]) -> Tree:
        ends = _cuts(text, LEAF)
        width = 1
        while width < len(ends):
            width *= 2
        tree = cls([0] * (2 * width), [0] * (2 * width))
        begin = 0
        for i, end in enumerate(ends):
            tree.chars[width + i], tree.tokens[width + i] = end - begin, count(text[begin:end])
            begin = end
        for i in range(width - 1, 0, -1):
            tree._add_up(i)
        return tree

    def _add_up(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one for the end), and where it begins."""
        i, begin = 1, 0
        while i < self.width:
            left = self.chars[2 * i]
            i, begin = (2 * i, begin) if place - begin < left or not self.chars[2 * i + 1] else (2 * i + 1, begin + left)
        return i - self.width, begin

    def put(self, first: int, sizes: list[tuple[int, int]]) -> None:
        """Set consecutive leaves and correct the sums above them."""
        for i, (chars, tokens) in enumerate(sizes, self.width + first):
            self.chars[i], self.tokens[i] = chars, tokens
        low, high = (self.width + first) // 2, (self.width + first + len(sizes) - 1) // 2
        while low >= 1:
            for i in range(low, high + 1):
                self._add_up(i)
            low, high = low // 2, high // 2


def edit(text: str, tree: Tree, start: int, removed: int, inserted: str, count: Callable[[str], int]) -> tuple[str, Tree, int]:
    """The text and tree after an edit, and how many characters were encoded for it.

    ``start`` and ``removed`` are cut to the text, so an edit behind the end appends.
    """
    start = min(max(0, start), len(text))
    stop = min(len(text), start + max(0, removed))
    first, begin = tree.leaf_at(start)
    last, at = tree.leaf_at(max(start, stop - 1))
    end = at + tree.chars[tree.width + last]
    text = text[:start] + inserted + text[stop:]
    end += len(inserted) - (stop - start)
    while first > 0 and not _sound(text, begin):
        first -= 1
        begin -= tree.chars[tree.width + first]
    while last < tree.width - 1 and end < len(text) and not (end and _sound(text, end)):
        last += 1
        end += tree.chars[tree.width + last]
    region, leaves = text[begin:end], last - first + 1
    ends = _cuts(region, max(LEAF, -(-len(region) // leaves)))
    if len(region) > 4 * LEAF * leaves or len(ends) > leaves:
        # Much was inserted: the tree gets leaves of usual size in this region, the others stay as they are.
        ends = _cuts(region, LEAF)
        old = [(tree.chars[i], tree.tokens[i]) for i in range(tree.width, 2 * tree.width)]
        fresh = [(b - a, count(region[a:b])) for a, b in zip([0, *ends], ends)]
        rows = [x for x in old[:first] + fresh + old[last + 1:] if x[0]] or [(0, 0)]
        width = 1
        while width < len(rows):
            width *= 2
        tree = Tree([0] * (2 * width), [0] * (2 * width))
        tree.put(0, rows + [(0, 0)] * (width - len(rows)))
    else:
        fresh = [(b - a, count(region[a:b])) for a, b in zip([0, *ends], ends)]
        tree.put(first, fresh + [(0, 0)] * (leaves - len(ends)))
    return text, tree, len(region)


def _ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def build(docs: DataFrame, ranks: str, pattern: str, text_col: str = "text") -> DataFrame:
    """All rows plus ``tree`` (sums of characters and tokens) and ``n_tokens``, by a rank file and a split pattern.

    Whole texts are counted; NULL and empty texts have a tree of no tokens. Columns of these names are replaced.
    """
    file = _ranks(ranks)

    def plant(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = _counter(file, pattern)
        for column in columns:
            trees = [Tree.of(text or "", count) for text in column.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([getattr(t, k) for t in trees], pa.list_(pa.int32()))
                                              for k in ("chars", "tokens")], ["chars", "tokens"])

    plant.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    out = docs.withColumn("tree", F.arrow_udf(plant, _TREE).asNondeterministic()(text_col))
    return out.withColumn("n_tokens", F.element_at("tree.tokens", 2).cast("long"))


def apply(trees: DataFrame, edits_col: str, ranks: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The rows of ``build`` after their edits, with text, ``tree`` and ``n_tokens`` renewed, plus ``encoded``.

    ``edits_col`` is an array of ``seq, start, removed, inserted`` (characters), applied in order of ``seq``, ties in
    the array's order; NULL numbers are 0, NULL strings and arrays are empty. ``encoded`` is how many characters were
    encoded again for them. A NULL text is edited as an empty one.
    """
    file = _ranks(ranks)

    def follow(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        count = _counter(file, pattern)
        for batch in columns:
            rows = []
            for text, tree, edits in zip(*(c.to_pylist() for c in batch)):
                text, now, encoded = text or "", Tree(tree["chars"], tree["tokens"]), 0
                for e in sorted((e for e in edits or [] if e is not None), key=lambda e: e["seq"] or 0):
                    text, now, n = edit(text, now, e["start"] or 0, e["removed"] or 0, e["inserted"] or "", count)
                    encoded += n
                rows.append((text, now.chars, now.tokens, encoded))
            kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64())
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             ["text", "chars", "tokens", "encoded"])

    follow.__annotations__ = {"columns": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    out = trees.withColumn("_new", F.arrow_udf(follow, _EDITED).asNondeterministic()(text_col, "tree", edits_col))
    return out.withColumns({
        text_col: F.col("_new.text"), "tree": F.struct("_new.chars", "_new.tokens"),
        "n_tokens": F.element_at("_new.tokens", 2).cast("long"), "encoded": F.col("_new.encoded")}).drop("_new")


def with_edits(trees: DataFrame, edits: DataFrame, id_col: str = "doc_id", edits_col: str = "edits") -> DataFrame:
    """Rows of ``build`` joined with their edits (``id_col, seq, start, removed, inserted``) as an array; all rows stay."""
    rows = edits.groupBy(id_col).agg(F.collect_list(F.struct("seq", "start", "removed", "inserted")).alias(edits_col))
    return trees.drop(edits_col).join(rows, id_col, "left")
