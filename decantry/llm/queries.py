"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    boosted_trees,
    byte_bpe,
    kneser_ney,
    line_dedup,
    line_quality,
    ngram_join,
    packing,
    pii,
    prefix_hash,
    spelling,
    substring,
    turn_trie,
    url_rules,
)
from .common import SPACE_CLASS, table, text_of, words_of

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}
LLM_SQL: dict[str, str] = {}

BPE_JSON = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_50k.tiktoken"


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of the session, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_decantry_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="decantry-code-")) / "decantry.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((root / "decantry").rglob("*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(str(archive))
    context._decantry_shipped = True


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        LLM_QUERIES[fn.__name__] = run
        if sql is not None:
            LLM_SQL[fn.__name__] = sql
        return run

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(modulus: int, remainder: int) -> Column:
    """Whether an id is in the fold that no label is learnt from; a NULL id is not."""
    return F.coalesce(
        F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False)
    )


URL_RULES = [
    url_rules.Rule.read("allow", "com/"),
    url_rules.Rule.read("block", "example.com/en/"),
    url_rules.Rule.read("allow", "www.example.com/en/"),
    url_rules.Rule.read("block", "net/es/"),
    url_rules.Rule.read("block", "net/fr/"),
]

URL_SQL = r"""
with parts as (
  select page_id, url,
    coalesce(case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end, '') as rest,
    coalesce(regexp_extract(url, '\?([^#]*)', 1), '') as query
  from pages
),
split as (
  select *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
),
tokens as (
  select page_id, url, host, path, list_sort(list_distinct(
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''),
                   lambda x: 'host:' || regexp_replace(x, '[0-9]+', '#', 'g'))
    || list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
                      lambda x: 'path:' || regexp_replace(x, '[0-9]+', '#', 'g'))
    || list_transform(list_filter(list_transform(string_split(query, '&'),
                                                 lambda x: string_split(x, '=')[1]), lambda x: x <> ''),
                      lambda x: 'name:' || regexp_replace(x, '[0-9]+', '#', 'g')))) as has
  from split
),
known as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
  from labels group by doc_id
),
learnt as (
  select t.has, k.bad from tokens t join known k on t.page_id = k.doc_id where t.url is not null
),
limits as (select 20 as least),
learnt_sets as (
  select bad, list_filter(has, lambda x, i: (mask >> (i - 1)) % 2 = 1) as s
  from (select *, unnest(range(1, 1 << len(has))) as mask from learnt)
),
rules as (
  select s from learnt_sets, limits group by s, least
  having sum(bad) >= least and sum(bad) * 2 >= count(*)
),
fitted as (
  select distinct url from tokens t join rules r on len(list_intersect(t.has, r.s)) = len(r.s)
),
judged as (
  select page_id, host, path, url in (select url from fitted) as mined,
    case when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%'
           then 'www.example.com/en/'
         when (host = 'example.com' or host like '%.example.com') and path like '/en/%'
           then 'example.com/en/'
         when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
         when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
         when (host = 'com' or host like '%.com') and path like '/%' then 'com/' end as rule
  from tokens
)
select page_id, host, path, rule,
       case when rule in ('www.example.com/en/', 'com/') then 'allow'
            when rule is not null then 'block'
            when mined then 'block' else 'allow' end as verdict
from judged
"""


@query(URL_SQL)
def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a document are taken for the page with the same id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = (
        table(spark, sf_dir, "labels")
        .groupBy("doc_id")
        .agg(F.max(F.coalesce(bad, F.lit(False))).alias("block"))
    )
    labelled = pages.join(known, F.col("page_id") == F.col("doc_id")).select("url", "block")
    return url_rules.judge(pages, URL_RULES, url_rules.mine(labelled))


QUALITY_SQL = r"""
with docs as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as body from documents),
words as (
  select doc_id, unnest(ws) as w, unnest(range(len(ws))) as i
  from (select doc_id, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'),
                                   lambda x: x <> '') as ws from docs)
),
windows as (
  select doc_id, i, w as w1, lead(w) over o as w2, lead(w, 2) over o as w3
  from words window o as (partition by doc_id order by i)
),
places as (
  select doc_id, i, count(*) over (partition by doc_id, w1, w2, w3) as n
  from windows where w3 is not null
),
repeats as (
  select doc_id, sum(step) as n from (
    select doc_id, least(3, i - coalesce(lag(i) over (partition by doc_id order by i), -3)) as step
    from places where n > 1
  ) group by doc_id
),
counts as (select doc_id, count(*) as n_words, sum(length(w)) as word_chars from words group by doc_id),
lines as (
  select doc_id, host, body,
         trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as stripped, line
  from (select *, unnest(string_split(body, chr(10))) as line from docs)
),
full_lines as (
  select *, translate(translate(stripped, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz'), '123456789', '000000000') as norm
  from lines where stripped <> ''
),
dups as (select doc_id, count(*) - count(distinct line) as n from full_lines group by doc_id),
sizes as (select host, count(distinct body) as docs from docs group by host),
common as (
  select host, norm, count(distinct body) as n from full_lines group by host, norm
),
boilerplate as (
  select c.host, c.norm from common c join sizes s on c.host = s.host
  where c.n > 20 and c.n > 0.01 * s.docs
),
removed as (
  select l.doc_id, sum(len(list_filter(regexp_split_to_array(l.line, '[\x20\x09-\x0D]+'),
                                       lambda x: x <> ''))) as n
  from full_lines l join boilerplate b on l.host = b.host and l.norm = b.norm group by l.doc_id
),
base as (
  select d.doc_id, coalesce(c.n_words, 0) as n_words, coalesce(c.word_chars, 0) as word_chars,
         length(regexp_replace(d.body, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(u.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
         coalesce(m.n, 0) as n_boilerplate_words
  from docs d left join counts c on d.doc_id = c.doc_id left join dups u on d.doc_id = u.doc_id
  left join repeats r on d.doc_id = r.doc_id left join removed m on d.doc_id = m.doc_id
),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and n_words - n_boilerplate_words >= 50
       and n_words - n_boilerplate_words >= 0.5 * n_words as kept, n_boilerplate_words
from judged
"""


@query(QUALITY_SQL)
def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    judged = line_quality.judge(docs, keep=["doc_id"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), "*").drop("row")


JACCARD_SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') as ws
  from documents
),
grams as (
  select distinct doc_id, unnest(case
    when len(ws) = 0 then []
    when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    end) as gram
  from words
),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from grams a join grams b on a.gram = b.gram and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id
),
links as (
  select c.a, c.b from common c join sizes s on c.a = s.doc_id join sizes t on c.b = t.doc_id
  where 5 * c.n >= 4 * (s.n + t.n - c.n)
),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on r.b = l.a
)
select d.doc_id, (select min(b) from reach r where r.a = d.doc_id) as class_id,
       (select count(*) from links l where l.a = d.doc_id) as n_links
from documents d
"""


@query(JACCARD_SQL)
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.near_duplicates(docs).select("doc_id", "class_id", "n_links")


@query()
def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    out = held_out(5, 0)
    model = kneser_ney.train(docs, labels, "toxic", ~out)
    return kneser_ney.score(docs, model).select(
        "doc_id",
        out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


LINE_DEDUP_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i
  from documents
),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
),
common as (
  select key, max(doc_id) as latest from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
)
select k.doc_id, count(*) as n_lines,
       count(*) filter (where c.key is not null and k.doc_id <> c.latest) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i)
              filter (where c.key is null or k.doc_id = c.latest), '')) as kept_sha256
from keyed k left join common c on k.key = c.key
group by k.doc_id
"""


@query(LINE_DEDUP_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = line_dedup.drop_lines(docs, line_dedup.line_keeps(docs))
    return left.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(text_of("text").cast("binary"), 256).alias("kept_sha256"),
    )


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary(BPE_JSON), size=1024, end_id=0, with_ids=False)


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    path = vocabulary(BPE_RANKS)
    tokens = byte_bpe.encode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        "ids",
    )
    return byte_bpe.decode(tokens, path, ranked=True).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256")
    )


@query()
def op8_prefix_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op9_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    out = held_out(4, 2)
    model = boosted_trees.train(docs, labels, "quality", ~out)
    return boosted_trees.score(docs, model).select(
        "doc_id",
        out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query()
def op10_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = substring.drop_windows(docs, substring.repeated_windows(docs))
    trimmed = F.regexp_replace(text_of("text"), f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    one_space = F.regexp_replace(trimmed, f"{SPACE_CLASS}+", " ")
    return left.select(
        "doc_id",
        (F.size(words_of(text_of("text"))) + F.col("n_removed")).cast("long").alias("n_words"),
        "n_removed",
        F.sha2(one_space.cast("binary"), 256).alias("kept_sha256"),
    )


# Unsigned crc32 of the UTF-8 bytes of ``{text}``, byte by byte with a table made by rule.
CRC_TABLE_SQL = """crc_steps as (
  select list(list_reduce(range(8), lambda c, bit: case when c % 2 = 1
                then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as steps
  from range(256) as r(i)
)"""


def crc_sql(text: str) -> str:
    byte = f"instr('0123456789ABCDEF', substr(hex({text}), 2 * k + 1, 1)) * 16 + instr('0123456789ABCDEF', substr(hex({text}), 2 * k + 2, 1)) - 17"
    return f"""xor(4294967295, list_reduce(list_transform(range(octet_length(encode({text}))), lambda k: {byte}),
      lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295))"""


SPELLING_SQL = rf"""
with recursive {CRC_TABLE_SQL},
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents)
  group by 1, 2
),
hashed as (
  select run, n, {crc_sql("doc_id || ':' || run")} as h from runs, crc_steps where length(run) >= 7
),
words as (
  select word, sum(n)::bigint as n from (
    select n, case when h % 31 = 0
      then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
      else run end as word
    from hashed
  ) where length(word) >= 7 group by word having sum(n) >= 2
),
holes as (
  select word, n, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) as hole
  from words, lateral (select unnest(range(1, length(word) + 1)) as i)
),
near as (
  select a.word, b.word as near, b.n from holes a join holes b
    on a.i = b.i and a.hole = b.hole and a.word <> b.word
  union
  select h.word, w.word, w.n from holes h join words w on h.hole = w.word
  union
  select w.word, h.word, h.n from holes h join words w on h.hole = w.word
),
best as (
  select word, count(*) as n_near, arg_min(near, struct_pack(a := -n, b := near)) as near, max(n) as near_n
  from near group by word
),
judged as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near,
         case when b.near_n >= 10 * w.n then b.near end as form,
         case when b.near_n >= 10 * w.n then b.near_n end as form_n
  from words w left join best b on w.word = b.word
),
follow as (
  select word, word as root from judged where form is null
  union all
  select j.word, f.root from judged j join follow f on j.form = f.word
)
select j.word, j.form, f.root, j.n, j.n_near, j.form_n from judged j join follow f on j.word = f.word
"""


@query(SPELLING_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.count_words(docs, lose_every=31))


@query()
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    base = F.filter("found", lambda s: s["base"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


TRIE_SQL = rf"""
with {CRC_TABLE_SQL},
said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
),
keyed as (select *, md5(length(role) || ':' || role || text) as k, length(text) as chars from said),
turns as (
  select conv_id, k, chars,
         row_number() over (partition by conv_id order by turn nulls first, role, k) as pos
  from keyed
),
convs as (
  select conv_id, conv_id - conv_id % 100 as base, {crc_sql("conv_id::varchar")} % 6 as h
  from (select distinct conv_id from turns), crc_steps
),
lent as (
  select c.conv_id, t.pos as d, t.k, t.chars from convs c join turns t on t.conv_id = c.base and t.pos <= c.h
),
rebuilt as (
  select * from lent
  union all
  select t.conv_id, t.pos - c.h + (select count(*) from lent l where l.conv_id = c.conv_id), t.k, t.chars
  from turns t join convs c on t.conv_id = c.conv_id where t.pos > c.h
),
paths as (
  select conv_id, d as depth, chars,
         md5(string_agg(k, '') over (partition by conv_id order by d)) as key,
         d = count(*) over (partition by conv_id) as last
  from rebuilt
  union all
  select c.conv_id, 0, 0, '', c.conv_id not in (select conv_id from rebuilt) from convs c
),
nodes as (
  select key, depth, min(conv_id) as conv_id, count(*) as n_convs, max(chars) as chars,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where last), '')) as ends_sha256
  from paths group by key, depth
),
linked as (
  select n.*, u.conv_id as parent_conv_id, u.key as parent_key
  from nodes n left join paths p on p.conv_id = n.conv_id and p.depth = n.depth - 1
  left join nodes u on u.key = p.key and u.depth = p.depth
),
kids as (select parent_key as key, depth - 1 as depth, count(*) as n from linked where depth > 0 group by 1, 2),
counted as (
  select l.*, coalesce(k.n, 0) as n_children from linked l left join kids k on l.key = k.key and l.depth = k.depth
),
sums as (
  select p.key, p.depth, count(*) filter (where c.n_children = 0) as n_leaves,
         sum((c.n_convs - 1) * c.chars)::bigint as saved_tokens
  from counted c join paths p on p.conv_id = c.conv_id and p.depth <= c.depth group by 1, 2
)
select c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
from counted c join sums s on c.key = s.key and c.depth = s.depth
"""


@query(TRIE_SQL)
def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    heads = F.crc32(F.col("conv_id").cast("string")) % 6
    base = F.col("conv_id") - F.col("conv_id") % 100
    return turn_trie.trie(*turn_trie.spliced(turns, base, heads, most=5))
