"""Edit-aware token counts: a kept segment tree of pre-token counts for every document.

A document is kept as blocks of consecutive pre-tokens, the leaves of its tree;
every node holds the characters and the tokens below it.  A block starts where
a pre-token must start (see ``tokens``), so its count does not depend on its
neighbours.  An edit finds its blocks by descending the character sums, cuts
and encodes their edited text again (with the block before as boundary context
where the edit touches a block's first characters) and updates the sums on the
paths to the root.  The rest is neither cut nor encoded again, and the root
always holds the exact count of the edited text.

``TreeTable`` keeps the trees as a written table: the sums of all leaves of a
document in narrow columns, and the blocks.  A table of edits is joined to the
sums of the documents it names; these say which blocks are needed, and only
those are taken from the tables of the rounds that wrote them last, edited and
written, with the new sums, as the table of a new round.

Defined cases: a null text counts as empty (0 tokens); the edits of one round
refer to the text as it was before them and must not overlap; edits of unknown
documents are ignored; texts of any length are kept whole, one that holds an
added token's string in one block; repeated rows have a tree each; ties cannot
arise; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import BROADCAST_MAX_BYTES, ROW, keyed, ship, written
from mobility.llm.tokens import ID, VISIBLE, Encoder, encoder, vocabulary

#: Chunks of a leaf when the tree is built (more, up to the next place where one may start).
LEAF_CHUNKS = 32
#: A pre-token starts here whatever is before it.
_LEAF_START = re.compile(f" [{VISIBLE}]")
TEXTS = 64
#: Row ids that are sent to all executors, 8 bytes each.
BROADCAST_ROWS = BROADCAST_MAX_BYTES // 64

Edit = tuple[int, int, str]


class CountTree:
    """Token counts of one text under edits.

    No block but the first starts with a space and the first character of an
    added token's string, so that such a string, which holds no space, is
    encoded in its block as it is in the text.
    """

    def __init__(self, text: str, encode: Encoder):
        self.encode = encode
        keys = encode.chunks(text) or [""]
        self.n_chunks = len(keys)
        self.n_encoded = 0  # chunks encoded again since the tree was built
        self.changed: set[int] = set()  # leaves
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        tokens = np.fromiter((len(encode[k]) for k in keys), np.int64, len(keys)) // ID.itemsize
        added = {a[0] for a in encode.added}
        start = (not encode.spaced and bool(_LEAF_START.match(k)) and k[1] not in added for k in keys)
        cuts = np.flatnonzero(np.fromiter(start, bool, len(keys)))
        apart = np.searchsorted(cuts, np.arange(LEAF_CHUNKS, len(keys), LEAF_CHUNKS))
        starts = np.concatenate([[0], np.unique(cuts[apart[apart < len(cuts)]])]).astype(np.int64)
        chars = np.add.reduceat(sizes, starts)
        ends = np.cumsum(chars).tolist()
        self._grow({j: text[a:b] for j, (a, b) in enumerate(zip([0, *ends], ends))}, chars, np.add.reduceat(tokens, starts))

    @classmethod
    def kept(cls, encode: Encoder, blocks: dict[int, str], chars: np.ndarray, tokens: np.ndarray) -> CountTree:
        """A tree from its leaves' sums and the blocks that its edits need."""
        tree = cls.__new__(cls)
        tree.encode, tree.n_chunks, tree.n_encoded, tree.changed = encode, 0, 0, set()
        tree._grow(blocks, chars, tokens)
        return tree

    def _grow(self, blocks: dict[int, str], chars: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves = blocks
        self.n_leaves = len(chars)
        # node i has the children 2i and 2i + 1; leaf j is node width + j
        self.width = width = 1 << (len(chars) - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * width, np.int64), np.zeros(2 * width, np.int64)
        for sums, values in ((self.chars, chars), (self.tokens, tokens)):
            sums[width : width + len(values)] = values
            level = width
            while level > 1:
                sums[level // 2 : level] = sums[level : 2 * level : 2] + sums[level + 1 : 2 * level : 2]
                level //= 2

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    @property
    def n_chars(self) -> int:
        return int(self.chars[1])

    def text(self) -> str:
        return "".join(self._block(j) for j in range(self.n_leaves))

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """(characters, tokens) of every leaf."""
        return tuple(x[self.width : self.width + self.n_leaves] for x in (self.chars, self.tokens))

    def _block(self, leaf: int) -> str:
        return self.leaves[leaf] if self.chars[self.width + leaf] else ""

    def _leaf(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, or the last one with text; where it starts)."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.width, start

    def _set(self, leaf: int, text: str) -> None:
        keys = self.encode.chunks(text)
        self.n_encoded += len(keys)
        tokens = sum(len(self.encode[k]) for k in keys) // ID.itemsize
        self.leaves[leaf] = text
        self.changed.add(leaf)
        node = self.width + leaf
        more_chars, more_tokens = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def _region(self, start: int, end: int) -> tuple[int, int, int]:
        """(first leaf, last leaf, where the first starts) that an edit of [start, end) encodes again."""
        if not 0 <= start <= end <= self.n_chars:
            raise ValueError(f"edit [{start}, {end}) outside of a text of {self.n_chars} characters")
        first, at = self._leaf(start)
        last = self._leaf(end - 1)[0] if end > at + self.chars[self.width + first] else first
        if at and start - at < 2:  # the space and the character that make the block's start
            first, at = self._leaf(at - 1)
        return first, last, at

    def needed(self, edits: list[Edit]) -> list[int]:
        """The leaves with text that the edits of a round encode again."""
        found = set()
        for start, end, _ in edits:
            first, last, _ = self._region(start, end)
            found.update(range(first, last + 1))
        return sorted(j for j in found if self.chars[self.width + j])

    def replace(self, start: int, end: int, new: str) -> None:
        """Replaces the characters [start, end) of the text as it is now."""
        first, last, at = self._region(start, end)
        region = "".join(map(self._block, range(first, last + 1)))
        for leaf in range(first + 1, last + 1):
            if self.chars[self.width + leaf]:
                self._set(leaf, "")
        self._set(first, region[: start - at] + new + region[end - at :])

    def apply(self, edits: list[Edit]) -> None:
        """Edits whose positions refer to the text as it is before all of them."""
        limit = self.n_chars
        for start, end, new in sorted(edits, reverse=True):
            if end > limit:
                raise ValueError("edits overlap")
            self.replace(start, end, new)
            limit = start


_DIGITS = re.compile(r"[0-9]{6,}")


def cleaning_edits(text: str) -> list[Edit]:
    """The edits of a cleaning pass: repeated lines go, long digit runs outside of them become a mark."""
    edits, seen, at = [], set(), 0
    for line in text.split("\n"):
        end = at + len(line)
        if line and line in seen:
            edits.append((at - 1, end, ""))  # with the line break before it
        else:
            seen.add(line)
            edits.extend((at + m.start(), at + m.end(), "[NUM]") for m in _DIGITS.finditer(line))
        at = end + 1
    return edits


SUMS = [ROW, "doc_id", "round", "n_chunks", "n_tokens", "chars", "tokens", "rounds"]
LEAVES = "array<struct<leaf:int,text:string>>"
TREES = (
    f"{ROW} long, doc_id long, round int, n_chunks long, n_tokens long, chars binary, tokens binary, rounds binary, "
    f"leaves {LEAVES}, n_blocks_read long, n_encoded long"
)
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"
_LEAF = pa.struct([("leaf", pa.int32()), ("text", pa.string())])
_EDIT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])


def _tree_columns(rows: list[tuple]) -> list[pa.Array]:
    """The arrays of TREES rows."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.list_(_LEAF), pa.int64(), pa.int64()]
    return [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]


_TREE_NAMES = [*SUMS, "leaves", "n_blocks_read", "n_encoded"]


def _numbers(data: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(data, kind)


class TreeTable:
    """The trees of many documents as written tables: ``rounds[k]`` has the documents and blocks that round k wrote."""

    def __init__(self, vocabulary_path: str, rounds: list[DataFrame]):
        self.vocabulary_path, self.rounds = vocabulary_path, rounds

    @classmethod
    def build(cls, docs: DataFrame, vocabulary_path: str, edits_of: Callable[[str], list[Edit]] | None = None) -> TreeTable:
        """Trees of ``keyed`` documents.  The first round also holds the ``edits`` that ``edits_of`` finds in each text."""

        def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encode = encoder(vocabulary_path)
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    rows, edits = [], []
                    for row, doc_id, text in zip(*(batch.slice(at, TEXTS).column(i).to_pylist() for i in range(3))):
                        tree = CountTree(text, encode)
                        chars, tokens = (x.astype("<i8").tobytes() for x in tree.sums())
                        leaves = [{"leaf": j, "text": t} for j, t in tree.leaves.items()]
                        rounds = bytes(4 * tree.n_leaves)
                        rows.append((row, doc_id, 0, tree.n_chunks, tree.n_tokens, chars, tokens, rounds, leaves, 0, 0))
                        found = edits_of(text) if edits_of else []
                        edits.append([{"start": a, "end": b, "text": t} for a, b, t in found])
                    yield pa.RecordBatch.from_arrays(
                        [*_tree_columns(rows), pa.array(edits, pa.list_(_EDIT))], names=[*_TREE_NAMES, "edits"]
                    )

        ship(docs.sparkSession)
        texts = docs.select(ROW, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
        return cls(vocabulary_path, [written(texts.mapInArrow(grow, f"{TREES}, edits {EDITS}"), "trees", compression="zstd")])

    def sums(self) -> DataFrame:
        """The latest SUMS row of every document; no block is read."""
        every = self.rounds[0].select(*SUMS)
        if len(self.rounds) == 1:
            return every
        for r in self.rounds[1:]:
            every = every.unionByName(r.select(*SUMS))
        latest = every.groupBy(ROW).agg(F.max_by(F.struct(*SUMS), "round").alias("s"))
        return latest.select("s.*")

    def edited(self, edits: DataFrame) -> TreeTable:
        """The table after one round of edits: (_row, start, end, text) rows."""
        path, now = self.vocabulary_path, len(self.rounds)

        def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for row, chars, rounds, edits in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    chars, rounds = _numbers(chars), _numbers(rounds, "<i4")
                    tree = CountTree.kept(None, {}, chars, chars)
                    needed = np.array(tree.needed([(e["start"], e["end"], "") for e in edits]), int)
                    out += [(row, int(r), needed[rounds[needed] == r].tolist()) for r in np.unique(rounds[needed])]
                if out:
                    row, at, wanted = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row, pa.int64()), pa.array(at, pa.int32()), pa.array(wanted, pa.list_(pa.int32()))],
                        names=[ROW, "at", "wanted"],
                    )

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encode = encoder(path)
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    blocks = {b["leaf"]: b["text"] for b in row["blocks"] or ()}
                    n_read = len(blocks)
                    tree = CountTree.kept(encode, blocks, _numbers(row["chars"]), _numbers(row["tokens"]))
                    tree.apply([(e["start"], e["end"], e["text"] or "") for e in row["edits"]])
                    rounds = _numbers(row["rounds"], "<i4").copy()
                    rounds[sorted(tree.changed)] = now
                    chars, tokens = (x.astype("<i8").tobytes() for x in tree.sums())
                    leaves = [{"leaf": j, "text": tree.leaves[j]} for j in sorted(tree.changed) if tree.leaves[j]]
                    out.append(
                        (row[ROW], row["doc_id"], now, row["n_chunks"], tree.n_tokens, chars, tokens, rounds.tobytes(), leaves, n_read, tree.n_encoded)
                    )
                if out:
                    yield pa.RecordBatch.from_arrays(_tree_columns(out), names=_TREE_NAMES)

        asked = edits.groupBy(ROW).agg(F.collect_list(F.struct("start", "end", "text")).alias("edits"))
        index = written(self.sums().join(asked, ROW), "asked")
        wanted = written(index.select(ROW, "chars", "rounds", "edits").mapInArrow(plan, f"{ROW} long, at int, wanted array<int>"), "wanted")
        blocks = None
        for k, r in enumerate(self.rounds):
            here = wanted.filter(F.col("at") == k).drop("at")
            ids = here.select(ROW)
            small = ids.count() <= BROADCAST_ROWS  # else the blocks are shuffled to them
            some = r.select(ROW, "leaves").join(F.broadcast(ids) if small else ids, ROW, "left_semi").join(here, ROW)
            some = some.select(ROW, F.filter("leaves", lambda x: F.array_contains("wanted", x["leaf"])).alias("blocks"))
            blocks = some if blocks is None else blocks.unionByName(some)
        blocks = blocks.groupBy(ROW).agg(F.flatten(F.collect_list("blocks")).alias("blocks"))
        new = index.join(blocks, ROW, "left").select(ROW, "doc_id", "n_chunks", "chars", "tokens", "rounds", "edits", "blocks")
        return TreeTable(path, [*self.rounds, written(new.mapInArrow(apply, TREES), "trees", compression="zstd")])


def query(docs: DataFrame) -> DataFrame:
    """Counts before and after a round of cleaning edits, and what that round read and encoded of each document."""
    first = TreeTable.build(keyed(docs), vocabulary(), cleaning_edits)
    edits = first.rounds[0].select(ROW, F.explode("edits").alias("e")).select(ROW, "e.*")
    last = first.edited(edits)
    before = first.rounds[0].select(
        ROW, "doc_id", "n_tokens", F.size("edits").cast("long").alias("n_edits"), "n_chunks", (F.octet_length("chars") / 8).cast("long").alias("n_blocks")
    )
    after = last.rounds[1].select(ROW, F.col("n_tokens").alias("n_after"), F.col("n_encoded").alias("n_chunks_encoded"), "n_blocks_read")
    zero = F.lit(0).cast("long")
    return before.join(after, ROW, "left").select(
        "doc_id", "n_tokens", "n_edits", F.coalesce("n_after", "n_tokens").alias("n_tokens_edited"), "n_chunks",
        F.coalesce("n_chunks_encoded", zero).alias("n_chunks_encoded"), "n_blocks", F.coalesce("n_blocks_read", zero).alias("n_blocks_read"),
    )
