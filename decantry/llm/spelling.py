"""Spelling variants: words that differ by one code point, found on a trie kept as a table.

The trie is path-compressed: a node is a beginning after which words differ, an edge the
code points up to the next node or the end of a word. Words are looked up in it by a
frontier of states (word, position, node, edits) that a join with the edges moves one
level on. A word is in the trie itself, so its states without an edit are the nodes on
its own path; the edit is made at one of them, and from there on every level must match,
which leaves at most one edge per state. States that reach the end of a word are
neighbours.

An edit in the second half of a word leaves its first half as it is. So the nodes of a
word are those behind its middle, where few words go on differently, and edits in the
first half are found in a second trie, of the words read backwards. Both lie in one
table. Replacements are looked for by larger code points and insertions only; the rest
are the same pairs from the other side.

Nodes are named by a hash of their beginning. Two beginnings of one hash would add edges
and candidates, never take any away, and each candidate is looked up among the words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_chunks, join_unique, mix64, stored

MIN_CHARS = 7
MIN_COUNT = 2
# A form is that many times as frequent as its variant.
DOMINANCE = 10

# A task adds up its counts until it holds this many words, or has seen this many
# characters of text since it last passed them on.
HELD_WORDS = 1 << 18
HELD_CHARS = 1 << 25

_LETTERS = "A-Za-zÀ-ÿ"


def lose_letter(doc_id: int | None, word: str, every: int) -> str:
    """``word`` without one code point if ``every`` divides its hash in this document."""
    if doc_id is None:
        return word
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % every:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def _counted(batches: Iterator[pa.RecordBatch], min_chars: int, every: int | None):
    # A run is taken whole from its first letter on, so shorter ones are left out here.
    run = re.compile(f"[{_LETTERS}]{{{min_chars},}}")
    held: Counter[str] = Counter()
    seen = 0

    def flush():
        names = pa.array(list(held.keys()), pa.string())
        yield pa.record_batch([names, pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            if not text:
                continue
            # Only A-Z have a lower case as bytes.
            lower = text.encode().lower().decode()
            if len(text) < HELD_CHARS >> 3:
                runs = Counter(run.findall(lower))
            else:
                runs = Counter(m[0] for m in run.finditer(lower))
            for word, n in runs.items():
                if every:
                    word = lose_letter(doc_id, word, every)
                    if len(word) < min_chars:
                        continue
                held[word] += n
            seen += len(text)
            if len(held) > HELD_WORDS or seen > HELD_CHARS:
                yield from flush()
                seen = 0
    yield from flush()


def count_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    lose_every: int | None = None,
) -> DataFrame:
    """``word`` and ``n``: the letter runs of all texts, lower-cased (A-Z) and counted.

    With ``lose_every`` a run loses one code point where that divides the hash of its
    document's id and itself, which puts misspellings into tables without any; rows with
    a NULL id lose none. NULL and empty texts have no words; repeated rows all count.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(
        partial(_counted, min_chars=min_chars, every=lose_every), "word string, n long"
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _beginnings(batches: Iterator[pa.RecordBatch]):
    """Per word, direction and length from the middle on: hash and next code point (0: end)."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        words = batch.column(1).to_pylist()
        for lo, hi in in_chunks(words, 1 << 18):
            for back in (False, True):
                part = [w[::-1] for w in words[lo:hi]] if back else words[lo:hi]
                yield _hashed(ids[lo:hi], part, back)


def _hashed(ids: np.ndarray, words: list[str], back: bool) -> pa.RecordBatch:
    size = np.array([len(w) for w in words], np.int64)
    start = np.cumsum(size) - size
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    place = (np.arange(len(code)) - np.repeat(start, size)).astype(np.uint64)
    # A hash of a beginning is the sum of one per place and code point (and direction).
    each = mix64(mix64(place * np.uint64(2) + np.uint64(back)) + code)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])

    first = (size - 1) // 2
    rows = size - first + 1
    word = np.repeat(np.arange(len(words)), rows)
    cut = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows) + first[word]
    node = total[start[word] + cut] - total[start[word]]
    after = np.append(code, np.uint64(0))[start[word] + cut]
    after[cut == size[word]] = 0
    return pa.record_batch(
        [
            pa.array(ids[word]),
            pa.array(np.full(len(word), back)),
            pa.array(cut.astype(np.int32)),
            pa.array(node.view(np.int64)),
            pa.array(after.astype(np.int32)),
        ],
        ["id", "back", "p", "node", "after"],
    )


def _letter_bit(code_point: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (code_point % 64).cast("int"))


def _alive(states: DataFrame) -> DataFrame:
    """Without states that are at the end of their word where none ends, or whose next
    letter does not lead on. Letters may share a bit, so some go only on the next level."""
    at_end = F.col("pos") == F.length("t")
    bit = _letter_bit(F.ascii(F.substr("t", F.col("pos") + 1, F.lit(1))))
    leads = F.col("onward").bitwiseAND(bit) != 0
    return states.filter(F.when(at_end, F.col("ends")).otherwise(leads)).drop("onward")


def _paths(words: DataFrame) -> DataFrame:
    """Per word and direction its letters ``s`` and its nodes ``cuts`` (p, node, ends, onward)."""
    begun = stored(
        words.select("id", "word").mapInArrow(
            _beginnings, "id long, back boolean, p int, node long, after int"
        )
    )
    nodes = (
        begun.groupBy("node")
        .agg(
            F.min("after").alias("least"),
            F.max("after").alias("most"),
            F.bit_or(F.when(F.col("after") > 0, _letter_bit(F.col("after"))).otherwise(0)).alias("onward"),
        )
        .filter("least <> most")
        .select("node", (F.col("least") == 0).alias("ends"), "onward")
    )
    cuts = (
        join_unique(begun.drop("after"), nodes, "node")
        .groupBy("id", "back")
        .agg(F.array_sort(F.collect_list(F.struct("p", "node", "ends", "onward"))).alias("cuts"))
    )
    s = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    return cuts.join(words.select("id", "word"), "id").select("id", "back", s.alias("s"), "cuts")


def _edges(paths: DataFrame) -> DataFrame:
    """``node``, ``label``, the ``child`` it leads to, whether a word ``ends`` there and
    which letters lead ``onward`` (a mask)."""
    size, zero = F.length("s"), F.lit(0).cast("long")
    leaf = F.struct(size.alias("p"), zero.alias("node"), F.lit(True).alias("ends"), zero.alias("onward"))
    last = F.element_at("cuts", -1)
    stops = F.when(last["p"] < size, F.concat("cuts", F.array(leaf))).otherwise(F.col("cuts"))
    pairs = F.arrays_zip(
        F.slice("stops", 1, F.size("stops") - 1).alias("a"),
        F.slice("stops", 2, F.size("stops") - 1).alias("b"),
    )
    return (
        paths.select("s", stops.alias("stops"))
        .filter(F.size("stops") > 1)
        .select("s", F.explode(pairs).alias("e"))
        .select(
            F.col("e.a.node").alias("node"),
            F.substr("s", F.col("e.a.p") + 1, F.col("e.b.p") - F.col("e.a.p")).alias("label"),
            F.col("e.b.node").alias("child"),
            F.col("e.b.ends").alias("ends"),
            F.col("e.b.onward").alias("onward"),
        )
        .distinct()
    )


def _part(s: str, after: Column | int, count: Column | int) -> Column:
    """``count`` code points of column ``s``, after the first ``after`` ones."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.substr(s, as_column(after) + 1, as_column(count))


def _edited(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """The states after the one edit: ``t``, the word that is looked for, and how far it is matched.

    The edit is the first code point of an edge. The rest of that edge must match already.
    """
    size = F.length("s")
    least = F.when(F.col("back"), size - F.floor(size / 2)).otherwise(F.floor(size / 2))
    here = (
        paths.select("id", "back", "s", least.alias("least"), F.explode("cuts").alias("cut"))
        .filter(F.col("cut.p") >= F.col("least"))
        .select("id", "back", "s", F.col("cut.p").alias("p"), F.col("cut.node").alias("node"))
    )
    # As many edges as there are letters, at most.
    kids = edges.groupBy("node").agg(F.collect_list(F.struct("label", "child", "ends", "onward")).alias("kids"))
    p = F.col("p")
    one = F.substr("label", F.lit(1), F.lit(1))
    rest = F.substr("label", F.lit(2))
    more = F.length("label") - 1
    own = _part("s", p, 1)  # empty at the end of the word
    tried = (
        join_unique(here, kids, "node")
        .select("id", "back", "s", "p", F.inline("kids"))
        .filter(one != own)
        .withColumns(
            {
                "replaces": (own != "") & (one > own) & (_part("s", p + 1, more) == rest),
                "inserts": _part("s", p, more) == rest,
            }
        )
        .filter(F.col("replaces") | F.col("inserts"))
    )
    begin = F.concat(_part("s", 0, p), one)
    made = F.array_compact(
        F.array(
            F.when(F.col("replaces"), F.concat(begin, F.substr("s", p + 2))),
            F.when(F.col("inserts"), F.concat(begin, F.substr("s", p + 1))),
        )
    )
    end = (p + 1 + more).alias("pos")
    return _alive(
        tried.select("id", "back", F.explode(made).alias("t"), end, F.col("child").alias("node"), "ends", "onward")
    )


def _next_level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one edge on, where the edge matches."""
    turn = F.struct("node", F.substr("t", F.col("pos") + 1, F.lit(1)).alias("first"))
    keyed = edges.select(
        F.struct("node", F.substr("label", F.lit(1), F.lit(1)).alias("first")).alias("turn"),
        "label",
        "child",
        F.col("ends").alias("ends_there"),
        "onward",
    )
    # The edges are shuffled once more for the struct, so that a hot turn can be split.
    moved = states.withColumn("turn", turn).join(keyed, "turn")
    matched = moved.filter(_part("t", F.col("pos"), F.length("label")) == F.col("label"))
    pos = (F.col("pos") + F.length("label")).alias("pos")
    there = F.col("ends_there").alias("ends")
    return _alive(matched.select("id", "back", "t", pos, F.col("child").alias("node"), there, "onward"))


def near_words(words: DataFrame) -> DataFrame:
    """Pairs ``id``, ``near`` (a word) at one inserted or replaced code point, once each.

    ``words`` are distinct, with an ``id`` of their own. Of two words that differ by a
    replaced code point one has the other as ``near``; of two of different length the
    shorter has the longer one.
    """
    paths = stored(_paths(words))
    edges = stored(_edges(paths))
    states = stored(_edited(paths, edges))
    done = []
    while not states.isEmpty():
        whole = F.col("pos") == F.length("t")
        done.append(states.filter(whole))
        states = stored(_next_level(states.filter(F.col("pos") < F.length("t")), edges))
    done = done or [states]
    found = done[0]
    for level in done[1:]:
        found = found.unionByName(level)
    near = F.when(F.col("back"), F.reverse("t")).otherwise(F.col("t"))
    return found.select("id", near.alias("near")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """``word`` and the last of its forms; each round doubles the steps taken."""
    now = stored(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        both = join_unique(now, ahead, "root", "left")
        after = stored(both.select("word", F.coalesce("further", "root").alias("root"), "further"))
        if after.filter(F.col("further").isNotNull()).isEmpty():
            return after.drop("further")
        now = after.drop("further")


def variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """Each word with its form, the near word it is taken for.

    ``words`` has distinct ``word`` and ``n``. Added are ``form`` (the near word of largest
    ``n``, of equal ones the smallest, if it is ``dominance`` times as frequent as the
    word; else NULL), ``root`` (the last of the forms that follow from the word, itself
    without any), ``n_near`` and ``form_n``. Forms are more frequent than what they are
    the form of, so they lead in no circle. No words give no rows.
    """
    words = stored(words.select("word", "n", F.monotonically_increasing_id().alias("id")))
    near = near_words(words)
    named = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("id").alias("near_id"))
    # Whatever the hashes did, only words are neighbours.
    pairs = join_unique(join_unique(near, named, "near"), words, "id")
    pairs = stored(pairs)
    both = pairs.select("id", "near", "near_n").unionByName(
        pairs.select(
            F.col("near_id").alias("id"), F.col("word").alias("near"), F.col("n").alias("near_n")
        )
    )
    best = both.groupBy("id").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"),
    )
    most = -F.col("best.rank")
    dominated = most >= dominance * F.col("n")
    judged = stored(
        words.join(best, "id", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(dominated, F.col("best.near")).alias("form"),
            F.when(dominated, most).alias("form_n"),
        )
    )
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
