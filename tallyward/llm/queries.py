"""The numbered operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import alignment, copies, decontaminate, language, lines, near, pii, quality, search, substrings, tokens, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_decontamination")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.find_contamination(docs, table(spark, folder, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


SQL["op1_decontamination"] = r"""
with words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), items as (
    select item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where item_id is not null
), windows as (
    select distinct item_id, least(13, len(w)) as size, w[i : i + least(13, len(w)) - 1] as words
    from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from items where len(w) > 0)
), sizes as (
    select distinct size from windows
), starts as (
    select doc_id, size, i, w[i : i + size - 1] as words
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
          from words, sizes where len(w) >= size)
), hits as (
    select doc_id, item_id, i, size from starts join windows using (size, words)
), covered as (
    select doc_id, count(distinct k) as n_hit
    from (select doc_id, unnest(range(i, i + size)) as k from hits) group by doc_id
), named as (
    select doc_id, count(distinct item_id) as n_items,
        string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
    from hits group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
    coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from words left join covered using (doc_id) left join named using (doc_id)
"""


@query("op2_repeated_substrings")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = substrings.remove_repeats(docs)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_toxicity")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        held_out("doc_id"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def held_out(doc_id: str) -> Column:
    return F.coalesce(toxicity.fold(doc_id) == 1, F.lit(False)).alias("held_out")


@query("op4_pii")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.learn(docs))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [
        F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: B023
        for kind in pii.KINDS
    ]
    base = F.sha2(joined("base_spans").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, joined("spans").alias("spans"))


RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


@query("op5_url_trust")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), RULES)


@query("op6_language")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.filter(toxicity.fold("doc_id") != 1))
    named = language.identify(docs.drop("lang"), model)
    return named.select("doc_id", held_out("doc_id"), "lang_pred", "score")


@query("op7_line_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = lines.dedup_lines(docs)
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    # Each line left out as number:id:number, the last two of the line that stands for its class.
    parts = F.transform("removed", lambda r: F.concat_ws(":", r["line"], r["first_id"], r["first_line"]))
    removed = F.coalesce(F.array_join(parts, ","), F.lit("")).alias("removed")
    return cut.select("doc_id", "n_lines", "n_removed", removed, kept.alias("kept_sha256"))


SQL["op7_line_dedup"] = r"""
with recursive lines as (
    select doc_id, unnest(split) as line, unnest(range(0, len(split))) as place
    from (select doc_id, string_split(text, chr(10)) as split from documents where text is not null)
), texts as (
    select line, length(line) as n, min({'id': doc_id, 'place': place}) as first,
        row_number() over (order by line) as node
    from lines where length(line) >= 20 or regexp_matches(line, '[^\x20\x09-\x0D]') group by line
), reach as (
    select n as m, (n >= 20)::int + (n >= 60)::int + (n >= 240)::int as k
    from (select unnest(range(20, max(n) + 1)) as n from texts)
), segments as (
    select m, k, i, (i * m) // (k + 1) as begin, ((i + 1) * m) // (k + 1) - (i * m) // (k + 1) as size
    from (select m, k, unnest(range(0, k + 1)) as i from reach)
), met as (
    select distinct a.node as x, b.node as y, k
    from (select node, m, i, substr(line, begin + 1, size) as part from texts join segments on m = n) a
    join (
        select node, m, k, i, substr(line, begin + shift + 1, size) as part
        from (select *, unnest(range(-k, k + 1)) as shift from texts join segments on n - m between 0 and k)
        where begin + shift >= 0
    ) b using (m, i, part)
    where a.node <> b.node
), walk(x, y, s, t, edits) as (
    select x, y, a.line, b.line, k from met join texts a on a.node = x join texts b on b.node = y
    union
    select x, y, substr(s, p + 1 + ds), substr(t, p + 1 + dt), edits - 1
    from (
        select *, coalesce(list_position(list_transform(list_zip(string_split(s, ''), string_split(t, '')),
            lambda c: c[1] = c[2]), false) - 1, least(length(s), length(t))) as p
        from walk where edits > 0 and s <> t
    ), (values (1, 1), (0, 1), (1, 0)) as moves(ds, dt)
    where abs(length(s) - ds - length(t) + dt) < edits
), links as (
    select distinct x, y from walk where s = t
), both_ways as (
    select x, y from links union select y, x from links
), reached(node, other) as (
    select node, node from texts union select node, y from reached join both_ways on other = x
), classes as (
    select node, min(other) as class from reached group by node
), heads as (
    select line, min(first) over (partition by class) as head from texts join classes using (node)
), gone as (
    select doc_id, place, head from lines join heads using (line)
    where doc_id <> head.id or place <> head.place
), removed as (
    select doc_id, count(*) as n_removed,
        string_agg(place || ':' || head.id || ':' || head.place, ',' order by place) as removed
    from gone group by doc_id
), kept as (
    select doc_id, string_agg(line, chr(10) order by place) as text
    from lines l where not exists (select 1 from gone g where g.doc_id = l.doc_id and g.place = l.place)
    group by doc_id
)
select d.doc_id, case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as n_lines,
    coalesce(n_removed, 0) as n_removed, coalesce(removed, '') as removed,
    sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join removed using (doc_id) left join kept k on k.doc_id = d.doc_id
"""


@query("op8_quality_rules")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs, columns=["doc_id"])


@query("op9_near_duplicates")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents"))


SQL["op9_near_duplicates"] = r"""
with recursive words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), shingles as (
    select distinct doc_id, array_to_string(w[i : i + 4], ' ') as shingle
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), shared as (
    select a.doc_id as x, b.doc_id as y, count(*) as n
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
), links as (
    select x, y from shared join sizes sx on sx.doc_id = x join sizes sy on sy.doc_id = y
    where 100 * shared.n >= 85 * (sx.n + sy.n - shared.n)
), both_ways as (
    select x, y from links union all select y, x from links
), reached(doc_id, other) as (
    select doc_id, doc_id from documents
    union select reached.doc_id, y from reached join both_ways on other = x
), named as (
    select doc_id, min(other) as component_id from reached group by doc_id
)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from documents join named using (doc_id) left join sizes using (doc_id)
"""


@query("op10_byte_bpe")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_digests(docs).drop("text", "ids", "decoded")


def token_digests(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = tokens.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    return tokens.decode(coded, path).select(
        *coded.columns,
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op11_exact_dedup")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return copies.find_copies(table(spark, folder, "documents"))


SQL["op11_exact_dedup"] = r"""
with bare as (
    select doc_id, length(coalesce(text, '')) as n,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as t
    from documents
), ranked as (
    select *, first_value(doc_id) over (partition by t order by n desc, doc_id) as keep_id,
        count(*) over (partition by t) as group_size
    from bare
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from ranked
"""


@query("op12_lexical_search")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op12_lexical_search"] = r"""
with words as (
    select doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
    from documents
), sizes as (
    select doc_id, len(w) as n from words where len(w) > 0
), totals as (
    select count(*) as docs, sum(n)::bigint as terms from sizes
), queried as (
    select item_id, term, count(*) as times
    from (select item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
    group by all
), counted as (
    select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from words)
    where term in (select term from queried) group by all
), weighed as (
    select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as weight
    from counted, totals group by term, docs
), scored as (
    select item_id, doc_id, sum(times * weight
        * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::bigint as score
    from queried join counted using (term) join weighed using (term) join sizes using (doc_id), totals
    group by item_id, doc_id
), ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank
    from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


@query("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return alignment.align_tokenizers(docs, *paths).select("doc_id", *numbers, groups)
