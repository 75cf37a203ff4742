"""Document tables for tests, and plain Python versions of what the operators do."""

from __future__ import annotations

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
# Names that operators use inside; a document table may have them as well.
CLASHING = (
    "ids long, starts long, text_hash long, node string, keep string, line string, "
    "host string, row string, n_lines long, n_removed long, after string, score long, shard long"
)


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def docs(spark, rows, clashing=False):
    """``rows`` are (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1] or "")) for r in rows]
    made = spark.createDataFrame(full, SCHEMA)
    if clashing:
        for column in CLASHING.split(", "):
            name, kind = column.split()
            made = made.selectExpr("*", f"cast(7 as {kind}) as `{name}`")
    return made


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    out = []
    for _ in range(n):
        out.append(f"w{rng.randrange(vocabulary)}")
        out.append(rng.choice([" ", " ", " ", " ", "\n", "  ", "\t"]))
    return "".join(out)


def corpus(seed: int, n: int = 40) -> list[tuple[int | None, str | None, str | None]]:
    """Documents with copies, near copies, shared lines, a long one, NULLs and empties."""
    rng = random.Random(seed)
    shared = [f"this line stands in many documents, number {i}" for i in range(4)]
    rows: list[tuple[int | None, str | None, str | None]] = []
    for i in range(n):
        text = prose(rng, rng.choice([0, 1, 4, 5, 30, 60, 120]))
        for line in rng.sample(shared, rng.randrange(3)):
            text += "\n" + rng.choice([line, line.upper(), f"  {line}\t"])
        rows.append((i, text, rng.choice(["a", "b", None])))
    long = prose(rng, 3000, 4000)
    passage = " ".join(f"p{k}" for k in range(70))
    near = words(prose(rng, 200, 5000))
    rows += [(n, long, "a"), (n + 1, long + " end", "a"), (n + 2, long, "b")]
    for k in range(12):
        changed = list(near)
        for _ in range(k % 5):
            changed[rng.randrange(200)] = f"x{rng.randrange(99)}"
        rows.append((n + 3 + k, " ".join(changed), "a"))
        rows.append((n + 20 + k, prose(rng, 30, 5000) + passage + " " + prose(rng, 30, 5000), "b"))
    rows += [(n + 50, None, None), (n + 51, "", "a"), (n + 52, " \n\t", "a"), (n + 53, "one", "a")]
    return rows
