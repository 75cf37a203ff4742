"""Prefix trie of conversations, built in range shards of ternary search trees.

Turns become numbers of a dictionary and conversations sequences of such numbers; texts
are read once and never shuffled. Sequences are cut into blocks of ``BLOCK`` turns. Equal
sequences of a block become one row, and the rows, sorted and dealt by ranges, are put
into ternary search trees of bounded size, a middle one first. Each tree adds up members,
children, leaves and savings from its last node to its first. Only nodes on the first and
the last sequence of a tree can lie in another one as well; they are merged, by a digest
of the way to them, and what hangs below them is counted once.

A block's rows stand below the node that ends the block before, which is named by its
smallest member. Blocks are grouped from the first on and counted from the last on. What
only one conversation has left is a chain without branches and needs no tree, so there
are as many rounds as blocks that at least two conversations have in common, however
long one of them is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_unique, stored

# Turns of a block. A row has no more of them, and a node no more ancestors in its tree.
BLOCK = 64
# A tree is closed when it has this many nodes.
HELD_NODES = 200_000

_NODE = (
    "edge boolean, key binary, above array<binary>, parent_key binary, g long, depth int, conv_id long,"
    " parent_conv_id long, n_convs long, kids long, leaves long, saved long, chars long,"
    " end_rep long, end_n long, n_end long"
)


def numbered_turns(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``code`` and ``chars`` of every turn.

    Turns are in order of ``turn``, NULL first; turns of one number are in order of role
    and digest of role and text, and equal ones are all kept. A NULL role or text is empty.
    Rows without a ``conv_id`` belong to no conversation and are left out.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    digest = F.unhex(F.md5(F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said)))
    rows = stored(
        conversations.filter(F.col(conv_id).isNotNull()).select(
            F.col(conv_id).cast("long").alias("conv_id"),
            F.col(turn).alias("turn"),
            said[0].alias("role"),
            digest.alias("digest"),
            F.length(said[1]).cast("long").alias("chars"),
        )
    )
    dictionary = stored(
        rows.select("digest").distinct().withColumn("code", F.monotonically_increasing_id())
    )
    # Positions are counted over ranges: a conversation of very many turns, or of very
    # many equal ones, lies in several.
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "digest", "tie"]
    ranged = stored(
        join_unique(rows, dictionary, "digest")
        .withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "code", "chars", F.monotonically_increasing_id().alias("at"))
        .withColumn("place", F.struct("conv_id", F.shiftright("at", 33).alias("range")))
    )
    spans = ranged.groupBy("place").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # No more rows per conversation than ranges.
    earlier = F.expr(
        "sum(n) over (partition by place.conv_id order by place.range"
        " rows between unbounded preceding and 1 preceding)"
    )
    spans = spans.withColumn("earlier", F.coalesce(earlier, F.lit(0)))
    pos = F.col("earlier") + F.col("at") - F.col("first") + 1
    return join_unique(ranged, spans, "place").select("conv_id", pos.alias("pos"), "code", "chars")


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: turns (``conv_id``, ``size``, ``d``, ``code``, ``chars``)
    and members (``conv_id``, ``size``)."""
    members = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    rows = join_unique(turns, members, "conv_id")
    return rows.select("conv_id", "size", F.col("pos").alias("d"), "code", "chars"), members


def spliced(
    turns: DataFrame, base: Column, heads: Column, most: int
) -> tuple[DataFrame, DataFrame]:
    """As ``sequences``, with the first ``heads`` turns of each conversation (at most
    ``most``) replaced by those of conversation ``base``: all it has if fewer, none if there
    is no such conversation. Both are expressions of ``conv_id``."""
    turns = stored(turns)
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    members = counts.withColumns({"base": base, "heads": heads})
    lent = F.least("heads", F.coalesce("lender", F.lit(0)))
    lenders = counts.select(F.col("conv_id").alias("base"), F.col("own").alias("lender"))
    members = stored(
        join_unique(members, lenders, "base", "left").select(
            "conv_id",
            "base",
            "heads",
            lent.alias("lent"),
            (lent + F.greatest(F.col("own") - F.col("heads"), F.lit(0))).alias("size"),
        )
    )
    own = join_unique(turns, members.select("conv_id", "heads", "lent", "size"), "conv_id")
    own = own.filter(F.col("pos") > F.col("heads")).select(
        "conv_id", "size", (F.col("pos") - F.col("heads") + F.col("lent")).alias("d"), "code", "chars"
    )
    first = turns.filter(F.col("pos") <= most).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("d"), "code", "chars"
    )
    borrowed = (
        members.filter(F.col("lent") > 0)
        .join(first, "base")
        .filter(F.col("d") <= F.col("lent"))
        .select("conv_id", "size", "d", "code", "chars")
    )
    return own.unionByName(borrowed), members.select("conv_id", "size")


class Tree:
    """A ternary search tree over sequences of codes, as lists.

    ``lower`` and ``higher`` lead to other codes at the same place, ``below`` to what
    follows. A node's ``parent`` is the node of the turn before it and has a smaller
    number, so one pass from the last node to the first visits children before parents.
    """

    def __init__(self) -> None:
        self.code: list[int] = []
        self.lower: list[int] = []
        self.below: list[int] = []
        self.higher: list[int] = []
        self.parent: list[int] = []

    def _new(self, code: int, parent: int) -> int:
        self.code.append(code)
        self.parent.append(parent)
        for links in (self.lower, self.below, self.higher):
            links.append(-1)
        return len(self.code) - 1

    def insert(self, sequence: list[int]) -> list[int]:
        """The nodes of the sequence, from its first code on."""
        code, lower, below, higher = self.code, self.lower, self.below, self.higher
        path: list[int] = []
        parent = -1
        at = 0 if code else self._new(sequence[0], -1)
        for i, c in enumerate(sequence):
            while c != code[at]:
                side = lower if c < code[at] else higher
                if side[at] < 0:
                    side[at] = self._new(c, parent)
                at = side[at]
            path.append(at)
            if i + 1 < len(sequence):
                parent = at
                if below[at] < 0:
                    below[at] = self._new(sequence[i + 1], at)
                at = below[at]
        return path


def middles(n: int) -> Iterator[int]:
    """0 to n-1, the middle of every part before its halves."""
    parts = [(0, n)]
    while parts:
        lo, hi = parts.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            parts += [(lo, mid), (mid + 1, hi)]


def _tree_nodes(rows: list[dict]) -> pa.RecordBatch:
    """Nodes of one tree. ``rows`` are in order; their first code is the node above them."""
    tree = Tree()
    ends: dict[int, dict] = {}
    first_last: list[list[int]] = [[], []]
    chars: list[int] = []
    for i in middles(len(rows)):
        row = rows[i]
        path = tree.insert([row["g"], *row["seq"]])
        chars += [0] * (len(tree.code) - len(chars))
        for node, n in zip(path[1:], row["chars"], strict=True):
            chars[node] = n
        ends[path[-1]] = row
        if i == 0:
            first_last[0] = path
        if i == len(rows) - 1:
            first_last[1] = path

    # Digests of the way to the nodes that may lie in another tree, too.
    key: dict[int, bytes] = {}
    above: dict[int, list[bytes]] = {}
    for path in first_last:
        way, keys = hashlib.blake2b(digest_size=16), []
        for node in path:
            way.update(tree.code[node].to_bytes(8, "little", signed=True))
            key[node] = way.digest()
            keys.append(key[node])
            above[node] = keys[1:]  # without the node above the tree, with itself

    size = len(tree.code)
    members, kids, leaves, saved = ([0] * size for _ in range(4))
    least: list[int | None] = [None] * size
    for node in range(size - 1, -1, -1):
        row = ends.get(node)
        if row is not None:
            members[node] += row["n"]
            least[node] = row["rep"] if least[node] is None else min(least[node], row["rep"])
            kids[node] += row["kids"]
            leaves[node] += row["leaves"]
            saved[node] += row["saved"]
        parent = tree.parent[node]
        if parent < 0:
            continue  # the node above the rows
        if node not in key:
            leaves[node] += kids[node] == 0
            saved[node] += (members[node] - 1) * chars[node]
            kids[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
        members[parent] += members[node]
        least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])

    depth, group = [0] * size, list(tree.code)
    out: dict[str, list] = {c.split(" ")[0]: [] for c in _NODE.replace(", ", ",").split(",")}
    for node in range(size):
        parent = tree.parent[node]
        if parent < 0:
            continue
        depth[node], group[node] = depth[parent] + 1, group[parent]
        row = ends.get(node)
        top = depth[node] == 1
        out["edge"].append(node in key)
        out["key"].append(key.get(node))
        out["above"].append(above.get(node))
        out["parent_key"].append(None if top else key.get(parent))
        out["g"].append(group[node])
        out["depth"].append(depth[node])
        out["conv_id"].append(least[node])
        out["parent_conv_id"].append(group[node] if top else None if parent in key else least[parent])
        out["n_convs"].append(members[node])
        out["kids"].append(kids[node])
        out["leaves"].append(leaves[node])
        out["saved"].append(saved[node])
        out["chars"].append(chars[node])
        out["end_rep"].append(row and row["rep"])
        out["end_n"].append(row and row["n"])
        out["n_end"].append(row["n_end"] if row else 0)
    types = {
        "edge": pa.bool_(), "key": pa.binary(), "above": pa.list_(pa.binary()), "parent_key": pa.binary(),
        "depth": pa.int32(),
    }
    return pa.record_batch({k: pa.array(v, types.get(k, pa.int64())) for k, v in out.items()})


def _trees(batches: Iterator[pa.RecordBatch], held: int):
    rows: list[dict] = []
    nodes = 0
    for batch in batches:
        for row in batch.to_pylist():
            rows.append(row)
            nodes += len(row["seq"])
            if nodes >= held:
                yield _tree_nodes(rows)
                rows, nodes = [], 0
    if rows:
        yield _tree_nodes(rows)


def _merged(nodes: DataFrame) -> DataFrame:
    """Nodes of all trees of a round, those in several trees put together."""
    inner = nodes.filter(~F.col("edge"))
    # Per tree no more than two sequences.
    shared = nodes.filter("edge")
    once = stored(
        shared.groupBy("key").agg(
            *(F.max(c).alias(c) for c in ("above", "parent_key", "g", "depth", "chars", "end_rep", "end_n", "n_end")),
            *(F.sum(c).alias(c) for c in ("n_convs", "kids", "leaves", "saved")),
            F.min("conv_id").alias("conv_id"),
            F.max("parent_conv_id").alias("top"),
        )
    )
    more = once.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key"))
    kids = F.col("kids") + F.coalesce("shared_kids", F.lit(0))
    once = stored(
        once.join(more.agg(F.count("*").alias("shared_kids")), "key", "left").withColumns(
            {
                "kids": kids,
                "leaves": F.col("leaves") + (kids == 0).cast("long"),
                "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("chars"),
            }
        )
    )
    sums = (
        once.select(F.explode("above").alias("key"), "leaves", "saved")
        .groupBy("key")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    names = once.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named"))
    whole = once.drop("leaves", "saved").join(sums, "key").join(names, "parent_key", "left")
    columns = ["g", "depth", "conv_id", "n_convs", "kids", "leaves", "saved", "end_rep", "end_n", "n_end"]
    parent = F.coalesce("named", "top").alias("parent_conv_id")
    known = inner.filter("parent_key is null").select(*columns, "parent_conv_id")
    found = join_unique(inner.filter("parent_key is not null"), names, "parent_key")
    return (
        known.unionByName(found.select(*columns, F.col("named").alias("parent_conv_id")))
        .unionByName(whole.select(*columns, parent))
    )


def _hashed_ends(batches: Iterator[pa.RecordBatch]):
    """SHA-256 of the ids of each group, whose rows come in order; a batch at a time."""
    at, state = None, hashlib.sha256()

    def record(at, state):
        values = [pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([state.hexdigest()])]
        return pa.record_batch(values, ["depth", "end_rep", "sha"])

    for batch in batches:
        depth, rep = (batch.column(i).to_numpy() for i in (0, 1))
        ids = batch.column(2).to_pylist()
        if not ids:
            continue
        new = np.flatnonzero((depth[1:] != depth[:-1]) | (rep[1:] != rep[:-1])) + 1
        for lo, hi in zip([0, *new], [*new, len(ids)], strict=True):
            group = (int(depth[lo]), int(rep[lo]))
            joined = ",".join(map(str, ids[lo:hi])).encode()
            if group == at:
                state.update(b"," + joined)
            else:
                if at is not None:
                    yield record(at, state)
                at, state = group, hashlib.sha256(joined)
    if at is not None:
        yield record(at, state)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def trie(
    turns: DataFrame, members: DataFrame, block: int = BLOCK, held: int = HELD_NODES
) -> DataFrame:
    """One row per distinct beginning of conversations, the empty one included.

    ``turns`` and ``members`` come from ``sequences`` or ``spliced``; ``d`` counts without
    gaps from 1 to ``size``. Members of a beginning of ``depth`` turns are the
    conversations that start with it; ``conv_id`` is the smallest, ``parent_conv_id`` that
    of the beginning without its last turn (NULL for the root). ``n_children``,
    ``n_leaves`` (beginnings without children) and ``saved_tokens`` (code points of last
    texts that need not be repeated, over all but one member each) are of the trie below,
    the beginning itself included; ``ends_sha256`` is of the ids of members that end here,
    ascending and joined by commas. No conversations give no rows.
    """
    members = stored(members)
    total = members.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    index = F.floor((F.col("d") - 1) / block).cast("int")
    said = F.array_sort(F.collect_list(F.struct("d", "code", "chars")))
    blocks = stored(
        turns.groupBy("conv_id", "size", index.alias("b"))
        .agg(said.alias("said"))
        .select("conv_id", "size", "b", F.col("said.code").alias("seq"), F.col("said.chars").alias("chars"))
    )

    # From the first block on: which sequences there are, and where conversations end.
    least = F.lit(total["least"]).cast("long")
    active = blocks.filter("b = 0").withColumn("g", least)
    groups, ends, chains = [], [], []
    while True:
        r = len(groups)
        ended = F.col("size") == block * r + F.size("seq")
        here = stored(active.withColumn("ended", ended))
        group = stored(
            here.groupBy("g", "seq", "chars").agg(
                F.min("conv_id").alias("rep"),
                F.count("*").alias("n"),
                F.count_if("ended").alias("n_end"),
            )
        )
        groups.append(group)
        named = group.select(F.struct("g", "seq").alias("way"), "rep", "n", (F.col("n") - F.col("n_end")).alias("on"))
        # One conversation alone knows where it ends.
        alone = here.withColumn("way", F.struct("g", "seq"))
        placed = stored(join_unique(alone.drop("g", "seq", "chars"), named, "way").drop("way"))
        ends.append(
            placed.filter(F.col("ended") & (F.col("n") > 1)).select(
                F.col("size").alias("depth"), F.col("rep").alias("end_rep"), "conv_id"
            )
        )
        further = placed.filter(~F.col("ended")).select("conv_id", "rep", "on")
        if further.isEmpty():
            break
        rest = blocks.filter(F.col("b") > r)
        chains.append(
            join_unique(rest, further.filter("on = 1"), "conv_id").withColumn("start", F.lit(block * (r + 1)))
        )
        follow = further.filter("on > 1").select("conv_id", F.col("rep").alias("g"))
        active = join_unique(rest.filter(F.col("b") == r + 1), follow, "conv_id")
        if follow.isEmpty():
            break

    # From the last block on: what is below the end of each sequence.
    nodes, below = [], None
    for r in range(len(groups) - 1, -1, -1):
        rows = groups[r]
        on = F.col("n") - F.col("n_end")
        single = (on == 1).cast("long")
        if below is None:
            rows = rows.withColumns({"kids": single, "leaves": single, "saved": F.lit(0).cast("long")})
        else:
            rows = join_unique(rows, below, "rep", "left").withColumns(
                {
                    "kids": F.coalesce("kids", single),
                    "leaves": F.coalesce("leaves", single),
                    "saved": F.coalesce("saved", F.lit(0)),
                }
            )
        ranged = rows.repartitionByRange("g", "seq").sortWithinPartitions("g", "seq")
        made = stored(ranged.mapInArrow(partial(_trees, held=held), _NODE))
        round_nodes = stored(_merged(made))
        below = (
            round_nodes.filter("depth = 1")
            .groupBy(F.col("g").alias("rep"))
            .agg(F.count("*").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        )
        nodes.append(
            round_nodes.select(
                "conv_id",
                (F.col("depth") + block * r).cast("long").alias("depth"),
                "parent_conv_id",
                "n_convs",
                F.col("kids").alias("n_children"),
                F.col("leaves").alias("n_leaves"),
                F.col("saved").alias("saved_tokens"),
                "end_rep",
                "end_n",
                "n_end",
            )
        )
    for chain in chains:
        each = chain.select("conv_id", "size", "b", "rep", "start", F.posexplode("seq").alias("i", "code"))
        depth = F.col("b") * block + F.col("i") + 1
        last = depth == F.col("size")
        one = F.lit(1).cast("long")
        nodes.append(
            each.select(
                "conv_id",
                depth.cast("long").alias("depth"),
                F.when(depth == F.col("start") + 1, F.col("rep")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
                one.alias("n_convs"),
                (~last).cast("long").alias("n_children"),
                one.alias("n_leaves"),
                F.lit(0).cast("long").alias("saved_tokens"),
                F.when(last, F.col("conv_id")).alias("end_rep"),
                F.when(last, one).alias("end_n"),
                last.cast("long").alias("n_end"),
            )
        )

    silent = members.filter("size = 0")
    tops = nodes[len(groups) - 1].filter("depth = 1")  # the first block's
    root = tops.agg(
        F.count("*").alias("n_children"),
        F.greatest(F.coalesce(F.sum("n_leaves"), F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
    ).select(
        least.alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(total["n"]).alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        least.alias("end_rep"),
        F.lit(None).cast("long").alias("end_n"),
        F.lit(None).cast("long").alias("n_end"),
    )
    nodes.append(root.filter(F.lit(total["n"] > 0)))
    ends.append(
        silent.select(F.lit(0).cast("long").alias("depth"), least.alias("end_rep"), "conv_id")
    )

    # The ids of a group pass through one task, a batch at a time: a hash has one order.
    hashed = (
        _union(ends)
        .repartition("depth", "end_rep")
        .sortWithinPartitions("depth", "end_rep", "conv_id")
        .mapInArrow(_hashed_ends, "depth long, end_rep long, sha string")
    )
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    ends_sha = (
        F.when(F.col("n_end") == 0, nothing)
        .when(F.col("end_n") == 1, F.sha2(F.col("end_rep").cast("string").cast("binary"), 256))
        .otherwise(F.coalesce("sha", nothing))
    )
    return (
        _union(nodes)
        .join(hashed, ["depth", "end_rep"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            ends_sha.alias("ends_sha256"),
        )
    )
