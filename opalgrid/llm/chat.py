"""Formatting conversations for training, as prefix trees: turns that conversations begin with alike are written once.

A turn reads `### role: text</turn>` and a line feed. In texts and roles a backslash stands before each backslash and each
control string (`###`, `</turn>`; in roles also the colon), so texts cannot end a turn or begin one, and come back exactly.

Conversations are sorted by the digests of their turns, which is depth-first order of the tree, and each adds to a shard's
stream only the turns that the one before it has not begun with. Tokens are code points. Every turn of the stream is a node
with its place there, its parent, the position id of its first token, the intervals of the stream that its tokens may
attend to (its ancestors and itself, adjacent ones merged, causal within itself), and the interval that counts for the loss.

A shard is what a model reads at once: attention does not leave it, so a beginning that conversations of several shards
have in common is written once in each. A conversation beyond the bounds of turns.gathered has a shard of its own, in
several rows (chunks), which follow each other in the stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opalgrid.llm.common import claim
from opalgrid.llm.turns import CHARS, ROWS, gathered, rows_of

#: Characters after which a shard is closed.
SHARD = 4_000_000
SPOKEN = "assistant"  # whose texts count for the loss
END = "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)

SHARDS = (
    "shard string, chunk long, last boolean, offset long, text string, parent array<int>, start array<long>, position array<long>, attend_from array<array<long>>, attend_to array<array<long>>,"
    " loss_from array<long>, loss_to array<long>, conv_ids array<string>, leaves array<int>"
)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted(role: str, text: str) -> tuple[str, int]:
    """A turn, and where its text begins in it."""
    head = f"### {escaped(role, _CONTROL_ROLE)}: "
    return f"{head}{escaped(text)}{END}", len(head)


def parsed(stream: str) -> list[tuple[str, str]]:
    """The turns (role, text) of formatted text."""
    out, at = [], 0
    for m in _TURN.finditer(stream):
        if m.start() != at:
            break
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(stream):
        raise ValueError(f"no turn begins at {at}")
    return out


class Tree:
    """A shard while it is written."""

    def __init__(self, offset: int = 0) -> None:
        self.pieces: list[str] = []
        self.offset = self.size = offset
        self.nodes: dict[str, list] = {c: [] for c in ("parent", "start", "position", "attend_from", "attend_to", "loss_from", "loss_to")}
        self.lengths: list[int] = []
        self.path: list[tuple[str, str, int]] = []  # of the last conversation: role, text, node
        self.convs: list[str] = []  # empty for none
        self.leaves: list[int] = []

    def add(self, conv: str, roles: Sequence[str], texts: Sequence[str]) -> None:
        """A conversation; the next in order of paths, so that what it begins with is at hand."""
        same = 0
        while same < min(len(roles), len(self.path)) and self.path[same][:2] == (roles[same], texts[same]):
            same += 1
        del self.path[same:]
        for role, text in zip(roles[same:], texts[same:], strict=True):
            self._turn(role, text)
        self.convs.append(conv)
        self.leaves.append(self.path[-1][2])

    def _turn(self, role: str, text: str) -> None:
        turn, begin = formatted(role, text)
        n, parent, start, end = self.nodes, self.path[-1][2] if self.path else -1, self.size, self.size + len(turn)
        froms, tos = (n["attend_from"][parent], n["attend_to"][parent]) if parent >= 0 else ([], [])
        if tos and tos[-1] == start:
            froms, tos = froms, [*tos[:-1], end]
        else:
            froms, tos = [*froms, start], [*tos, end]
        position = n["position"][parent] + self.lengths[parent] if parent >= 0 else self.offset
        loss = (start + begin, end - len(END)) if role == SPOKEN else (start, start)
        for c, v in zip(n, (parent, start, position, froms, tos, *loss), strict=True):
            n[c].append(v)
        self.path.append((role, text, len(self.lengths)))
        self.lengths.append(len(turn))
        self.pieces.append(turn)
        self.size = end

    def frame(self, shard: str, chunk: int = 0, last: bool = True) -> pd.DataFrame:
        return pd.DataFrame({"shard": [shard], "chunk": [chunk], "last": [last], "offset": [self.offset], "text": ["".join(self.pieces)], **{c: [v] for c, v in self.nodes.items()}, "conv_ids": [self.convs], "leaves": [self.leaves]})


def trees(rows: DataFrame, *, shard: int = SHARD, chars: int = CHARS, most: int = ROWS) -> DataFrame:
    """Shards of rows (conv, turn, role, text); see SHARDS for the columns."""
    whole, parts = gathered(rows.withColumn("live", F.lit(True)), chars=chars, most=most)
    digest = lambda x: F.unhex(F.substring(F.md5(F.concat_ws(":", F.length(x["role"]), x["role"], x["text"])), 1, 16))
    path = F.aggregate(F.arrays_zip("role", "text"), F.lit(b""), lambda a, x: F.concat(a, digest(x)))
    named = F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("name")
    keyed = whole.select(named, path.alias("path"), "role", "text")
    order = [F.col("path"), F.col("name")]

    def grow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("turns")
        tree, made = Tree(), 0
        for frame in frames:
            for name, roles, texts in zip(frame["name"], frame["role"], frame["text"], strict=True):
                tree.add(name, roles, texts)
                if tree.size >= shard:
                    yield tree.frame(f"{TaskContext.get().partitionId()}-{made}")
                    tree, made = Tree(), made + 1
        if tree.convs:
            yield tree.frame(f"{TaskContext.get().partitionId()}-{made}")

    short = keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(grow, SHARDS)

    @F.pandas_udf("long")
    def measured(roles: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([sum(len(formatted(*t)[0]) for t in zip(r, x, strict=True)) for r, x in zip(roles, texts, strict=True)], dtype="int64")

    steps = Window.partitionBy("name").orderBy("part", "seq")
    sizes = parts.select(named, "part", "seq", measured("role", "text").alias("size"))
    places = sizes.select(
        "name", "part", "seq", F.row_number().over(steps).cast("long").alias("chunk"), F.coalesce(F.sum("size").over(steps.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.lead("seq").over(steps).isNull().alias("last"),
    )
    long_rows = parts.select(named, "part", "seq", "role", "text").join(places, ["name", "part", "seq"]).select("name", "chunk", "offset", "last", "role", "text")

    def chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("turns")
        for frame in frames:
            for name, chunk, offset, last, roles, texts in frame.itertuples(index=False):
                tree = Tree(int(offset))
                tree.add(name, roles, texts)
                n = tree.nodes
                n["attend_from"] = [[0] for _ in n["start"]]  # all that comes before, in earlier chunks too
                yield tree.frame(f"long-{name}", int(chunk), bool(last))

    return short.unionByName(long_rows.mapInPandas(chain, SHARDS))


class Reader:
    """What the turns of one conversation give, read in order."""

    def __init__(self) -> None:
        self.n = self.loss = self.chars = 0
        self.turns, self.spoken = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, masked: Sequence[str]) -> None:
        turns = parsed(text)
        self.turns.update("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass"))
        said = "".join(map(unescaped, masked))
        self.spoken.update(said.encode("utf-8", "surrogatepass"))
        self.n, self.loss, self.chars = self.n + len(turns), self.loss + len(said), self.chars + len(text)

    def row(self, conv: int | None) -> tuple:
        return conv, self.n, self.turns.hexdigest(), self.loss, self.spoken.hexdigest(), self.chars


def read(shards: DataFrame) -> DataFrame:
    """What each conversation of shards says: its turns, found by following attention intervals, and what is under its mask."""
    columns = ["shard", "last", "offset", "text", "parent", "attend_from", "attend_to", "loss_from", "loss_to", "conv_ids", "leaves"]

    def along(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("turns")
        last, reader = None, Reader()
        for frame in frames:
            for shard, end, offset, text, parent, froms, tos, loss_from, loss_to, convs, leaves in frame[columns].itertuples(index=False):
                out = []
                for conv, leaf in zip(convs, leaves, strict=True):
                    if shard != last or not shard.startswith("long-"):
                        last, reader = shard, Reader()
                    path, node = [], leaf
                    while node >= 0:
                        path.append(node)
                        node = parent[node]
                    within = [(max(a, offset) - offset, b - offset) for a, b in zip(froms[leaf], tos[leaf], strict=True)]
                    masked = [text[loss_from[i] - offset : loss_to[i] - offset] for i in reversed(path) if loss_to[i] > loss_from[i]]
                    reader.read("".join(text[a:b] for a, b in within), masked)
                    if end:
                        out.append(reader.row(int(conv) if conv else None))
                if out:
                    yield pd.DataFrame({c.split()[0]: pd.array(v, dtype="Int64") if c.endswith("long") else v for c, v in zip(DIGESTS.split(", "), zip(*out, strict=True), strict=True)})

    one = shards.where("chunk = 0").select(*columns).mapInPandas(along, DIGESTS)
    many = shards.where("chunk > 0").repartition("shard").sortWithinPartitions("shard", "chunk").select(*columns).mapInPandas(along, DIGESTS)
    return one.unionByName(many)


def table_of(conversations: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) of a table (conv_id, turn, role, text).

    Null roles and texts are empty; rows without conv_id are one conversation; turns go by number, null first, equal ones by
    role and the digest of the text, and repeated rows are turns that repeat. An empty table gives no shard. Texts of any
    length are taken whole. Other columns are not read.
    """
    return rows_of(conversations)
