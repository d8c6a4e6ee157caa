"""Queries for the operators on corpora, each over whole tables, and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import collect, dedup, lines, pieces, report, sampling, split, vocab
from textloom.plans import corpus
from textloom.session import shared_dir
from textloom.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# ---- building blocks of the SQL ----

SPACES = r"[\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}]+"


def sql_clean(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACES}', ' ', 'g'))"


def sql_lower(c: str) -> str:
    return f"lower(replace({c}, 'İ', 'i' || chr(775)))"


def sql_norm(c: str) -> str:
    return f"trim(regexp_replace({sql_lower(c)}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def sql_letters(c: str) -> str:
    return f"length(regexp_replace({c}, '[^\\p{{L}}]+', '', 'g'))"


REASON = f"""case when length(line) < 20 or length(line) > 2000 then 'length'
  when length(line) - length(replace(line, ' ', '')) < 2 then 'few_words'
  when {sql_letters('line')} < length(line) * 0.5 then 'low_letters' end"""
CLEAN = f"with clean as (select line_id, rec_id, source, config, shard, line_no, {sql_clean('text')} as line from shards where text is not null)"
USABLE = CLEAN + f", usable as (select * from clean where ({REASON}) is null)"
DOC_LINES = f"""with raw as (select doc_id, source, generate_subscripts(p, 1) - 1 as raw_no, unnest(p) as raw
  from (select doc_id, source, string_split(text, chr(10)) as p from documents where text is not null)),
lines as (select doc_id, source, raw_no, {sql_clean('raw')} as line from raw)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def clean(spark: SparkSession, d: str) -> DataFrame:
    return corpus.shard_lines(table(spark, d, "shards"))


def usable(spark: SparkSession, d: str) -> DataFrame:
    return corpus.usable(clean(spark, d))


def total_chars(spark: SparkSession, d: str, share: float) -> float:
    return float(int((usable(spark, d).agg(F.sum(F.length("line"))).first()[0] or 0) * share))


# ---- text functions ----


@query("line_clean", f"select line_id, {sql_clean('text')} as line from shards where text is not null")
def line_clean(s, d):
    return clean(s, d).select("line_id", "line")


@query("reject_reasons", CLEAN + f", r as (select source, coalesce({REASON}, 'ok') as reason, length(line) as n from clean) select source, reason, count(*) as lines, sum(n)::bigint as chars from r group by 1, 2")
def reject_reasons(s, d):
    return collect.reject_counts(clean(s, d))


@query("quality_flags", CLEAN + """, w as (select *, string_split(line, ' ') as w from clean)
select line_id, contains(line, chr(65533)) as replacement, length(line) > 40 and line = upper(line) and line <> """ + sql_lower("line") + """ as all_caps, contains(line, 'http') as url,
  len(w) >= 8 and len(list_distinct(w)) < len(w) * 0.3 as low_variety from w""")
def quality_flags(s, d):
    c = F.col("line")
    return clean(s, d).select("line_id", T.has_replacement(c).alias("replacement"), T.all_caps(c).alias("all_caps"), c.contains("http").alias("url"), T.low_variety(c).alias("low_variety"))


@query("dedup_keys", CLEAN + f" select line_id, md5({sql_norm('line')}) as key from clean")
def dedup_keys(s, d):
    return clean(s, d).select("line_id", F.md5(T.dedup_norm(F.col("line"))).alias("key"))


@query("clip_preview", f"""with c as (select doc_id, {sql_clean('text')} as line from documents where text is not null),
x as (select *, length(regexp_extract(substring(line, 601, 200), '^[^.!?]*[.!?]')) as e, length(regexp_extract(substring(line, 1, 600), '^((?s:.+)) ', 1)) as b from c)
select doc_id, case when length(line) <= 600 then line when e > 0 then substring(line, 1, 600 + e)
  else (case when b > 0 then substring(line, 1, b) else substring(line, 1, 600) end) || ' ...' end as preview from x""")
def clip_preview(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", T.clip(T.collapse_space(F.col("text"))).alias("preview"))


# ---- records and scans ----


@query("explode_lines", DOC_LINES + " select doc_id, raw_no, line from lines")
def explode_lines(s, d):
    return lines.explode_lines(table(s, d, "documents"), ["doc_id"], limit=None).select("doc_id", F.col("raw_no").cast("bigint").alias("raw_no"), "line")


@query("explode_lists", f"""with p as (select rec_id, config, generate_subscripts(texts, 1) - 1 as part_no, unnest(texts) as part from forum),
r as (select rec_id, config, part_no, generate_subscripts(q, 1) - 1 as raw_no, unnest(q) as raw from (select *, string_split(part, chr(10)) as q from p where part is not null))
select rec_id, config, part_no, raw_no, {sql_clean('raw')} as line from r""")
def explode_lists(s, d):
    x = lines.explode_lines(table(s, d, "forum"), ["rec_id", "config"], "texts", limit=None)
    return x.select("rec_id", "config", F.col("part_no").cast("bigint").alias("part_no"), F.col("raw_no").cast("bigint").alias("raw_no"), "line")


# One step takes the next sentence, or cuts the one at hand where it is above the limit.
SPLIT_LONG = DOC_LINES.replace("with raw", "with recursive raw") + f""", parts as (select doc_id, raw_no, raw, string_split(regexp_replace(raw, '([.!?…]){SPACES}', '\\1' || chr(2), 'g'), chr(2)) as ss from raw where length(raw) > 2000),
cuts as (select doc_id, raw_no, 0 as i, ''::varchar as s, ''::varchar as held, []::varchar[] as done, false as at_end, ss from parts
  union all select doc_id, raw_no, case when length(s) > 2000 then i else i + 1 end,
    case when length(s) > 2000 then regexp_replace(substring(s, k + 1), '^{SPACES}', '') else coalesce(ss[i + 1], '') end,
    case when length(s) > 2000 then '' when length(held) + 1 + length(s) <= 2000 then trim(held || ' ' || s) else s end,
    case when length(s) > 2000 then list_append(case when held = '' then done else list_append(done, held) end, substring(s, 1, k))
      when length(held) + 1 + length(s) <= 2000 or held = '' then done else list_append(done, held) end, i > len(ss), ss
  from (select *, case when length(regexp_extract(substring(s, 1, 2000), '^((?s:.+)) ', 1)) > 0 then length(regexp_extract(substring(s, 1, 2000), '^((?s:.+)) ', 1)) else 2000 end as k from cuts) where not at_end),
whole as (select doc_id, raw_no, case when held = '' then done else list_append(done, held) end as ps from cuts where at_end),
chunks as (select doc_id, raw_no, generate_subscripts(ps, 1) - 1 as chunk_no, unnest(ps) as piece from whole union all select doc_id, raw_no, 0, raw from raw where length(raw) <= 2000)
select doc_id, raw_no, chunk_no, {sql_clean('piece')} as line from chunks"""


@query("split_long", SPLIT_LONG)
def split_long(s, d):
    return lines.explode_lines(table(s, d, "documents"), ["doc_id"]).select("doc_id", F.col("raw_no").cast("bigint").alias("raw_no"), F.col("chunk_no").cast("bigint").alias("chunk_no"), "line")


@query("flagship", DOC_LINES + f", r as (select source, coalesce({REASON}, 'ok') as reason, length(line) as n from lines) select source, reason, count(*) as lines, sum(n)::bigint as chars from r group by 1, 2")
def flagship(s, d):
    return corpus.corpus_report(table(s, d, "documents"))


@query("record_filter", "select id, language_score, minhash_cluster_size from fineweb2 where (language_score is null or language_score >= 0.90) and (minhash_cluster_size is null or minhash_cluster_size <= 1000)")
def record_filter(s, d):
    return lines.usable_records(table(s, d, "fineweb2")).select("id", "language_score", "minhash_cluster_size")


@query("coalesce_fields", "select doc_id, coalesce(nullif(trim(title), ''), nullif(trim(url), ''), nullif(trim(source), '')) as field from documents")
def coalesce_fields(s, d):
    return table(s, d, "documents").select("doc_id", lines.first_text("title", "url", "source").alias("field"))


@query("every_field", f"with x as (select item_id, 0 as field_no, {sql_clean('text')} as line from eval_items where text is not null union all select item_id, 1, {sql_clean('answer')} from eval_items where answer is not null) select item_id, field_no, line from x where line <> ''")
def every_field(s, d):
    return lines.every_text(table(s, d, "eval_items"), ["item_id"], ["text", "answer"])


@query("field_profile", """with x as (
  select 'text' as field, 'string' as kind, count(text) as records, coalesce(sum(length(text)), 0)::bigint as total_chars from documents
  union all select 'lang', 'string', count(lang), coalesce(sum(length(lang)), 0)::bigint from documents union all select 'source', 'string', count(source), coalesce(sum(length(source)), 0)::bigint from documents
  union all select 'config', 'string', count(config), coalesce(sum(length(config)), 0)::bigint from documents union all select 'site', 'string', count(site), coalesce(sum(length(site)), 0)::bigint from documents
  union all select 'url', 'string', count(url), coalesce(sum(length(url)), 0)::bigint from documents union all select 'title', 'string', count(title), coalesce(sum(length(title)), 0)::bigint from documents
  union all select 'published', 'string', count(published), coalesce(sum(length(published)), 0)::bigint from documents)
select field, kind, records, total_chars, round(total_chars / nullif(records, 0), 6) as mean_chars, row_number() over (order by total_chars desc, field) = 1 as is_text from x""")
def field_profile(s, d):
    return lines.field_profile(table(s, d, "documents"))


@query("list_profile", """with x as (select 'texts' as field, 'array<string>' as kind, count(texts) as records, coalesce(sum(list_sum(list_transform(list_filter(texts, lambda x : x is not null), lambda x : length(x)))), 0)::bigint as total_chars from forum
  union all select 'url', 'string', count(url), coalesce(sum(length(url)), 0)::bigint from forum union all select 'config', 'string', count(config), coalesce(sum(length(config)), 0)::bigint from forum)
select field, kind, records, total_chars, round(total_chars / nullif(records, 0), 6) as mean_chars, row_number() over (order by total_chars desc, field) = 1 as is_text from x""")
def list_profile(s, d):
    return lines.field_profile(table(s, d, "forum"))


@query("column_drop", "select vec_id, label from embeddings")
def column_drop(s, d):
    return readers.read_records(s, f"{d}/embeddings.parquet", drop=["embedding"])


@query("resume_skip", "select doc_id, source from documents where doc_id > (select max(doc_id) from (select doc_id from documents order by doc_id limit 100))")
def resume_skip(s, d):
    return readers.skip_done(table(s, d, "documents"), "doc_id", 100).select("doc_id", "source")


@query("prefix_read", "select line_id, text from shards order by line_id limit 1000")
def prefix_read(s, d):
    """A trial read: the first lines in order; the limit is the feature."""
    return table(s, d, "shards").select("line_id", "text").orderBy("line_id").limit(1000)


@query("source_union", """with f as (select 'forum' as source, config, texts from forum), w as (select 'fineweb2' as source, 'default' as config, [text] as texts from fineweb2)
select source, config, count(*) as records, sum(len(texts))::bigint as parts from (select * from f union all select * from w) group by 1, 2""")
def source_union(s, d):
    x, _ = readers.read_sources(s, [{"source": "fineweb2", "path": f"{d}/fineweb2.parquet", "text": "text"}, {"source": "forum", "path": f"{d}/forum.parquet", "text": "texts"}, {"source": "gone", "path": f"{d}/no_such_table.parquet", "text": "text"}])
    named = x.drop("config").withColumn("config", F.when(F.col("source") == "forum", "all").otherwise("default"))
    f = table(s, d, "forum").select(F.lit("forum").alias("source"), "config", "texts")
    x = named.where("source <> 'forum'").select("source", "config", "texts").unionByName(f)
    return x.groupBy("source", "config").agg(F.count(F.lit(1)).alias("records"), F.sum(F.size("texts")).alias("parts"))


# ---- duplicates ----


@query("priority_dedup", USABLE + f""", r as (select u.line_id, u.source, row_number() over (partition by {sql_norm('line')} order by coalesce(s.priority, 1000000), u.line_id) as k
  from usable u left join sources s on s.name = u.source) select line_id, source from r where k = 1""")
def priority_dedup(s, d):
    return dedup.priority_dedup(usable(s, d), table(s, d, "sources")).select("line_id", "source")


@query("exact_dedup", CLEAN + " select min(line_id) as line_id from clean group by line")
def exact_dedup(s, d):
    return dedup.exact_dedup(clean(s, d)).select("line_id")


@query("duplicate_report", CLEAN + f""", k as (select coalesce(source, '?') as source, {sql_norm('line')} as k from clean)
select source, count(*) as lines, count(distinct k) as unique_keys, count(*) - count(distinct k) as duplicates from k group by 1
union all select null, count(*), count(distinct k), count(*) - count(distinct k) from k""")
def duplicate_report(s, d):
    return dedup.duplicate_report(clean(s, d))


# ---- quotas ----

TOTAL = ", total as (select trunc(sum(length(line)) * 0.5)::bigint as t from usable)"
STAGED = USABLE + TOTAL + f""",
q as (select name as source, priority, floor(quota * (select t from total)::double)::bigint as quota, priority = max(priority) over () as is_last from sources where quota > 0),
c as (select u.line_id, coalesce(u.rec_id, -1) as rec_id, u.source, q.priority, length(u.line) as n, {sql_norm('u.line')} as norm, q.quota, q.is_last from usable u join q on q.source = u.source),
f as (select * from c qualify row_number() over (partition by norm order by priority, line_id) = 1),
r as (select *, coalesce(sum(n) over (partition by source, rec_id order by line_id rows between unbounded preceding and 1 preceding), 0) as in_record from f),
p as (select *, coalesce(sum(n) over (partition by source order by line_id rows between unbounded preceding and 1 preceding), 0) as in_source from r where in_record < 20000),
o as (select coalesce(sum(n), 0) as others from p where in_source < quota and not is_last),
taken as (select line_id, source, n::bigint as n from p, o, total where in_source < case when is_last then greatest(t - others, 0) else quota end)"""


@query("collect_staged", STAGED + " select line_id, source, n from taken")
def collect_staged(s, d):
    return collect.collect_staged(usable(s, d), table(s, d, "sources"), total_chars(s, d, 0.5))


@query("source_summary", STAGED + """ select q.source, q.quota as target, count(taken.line_id) as lines, coalesce(sum(n), 0)::bigint as chars, round(coalesce(sum(n), 0) / nullif(q.quota, 0), 6) as share
from q left join taken on taken.source = q.source group by q.source, q.quota""")
def source_summary(s, d):
    total = total_chars(s, d, 0.5)
    return collect.source_summary(collect.collect_staged(usable(s, d), table(s, d, "sources"), total), table(s, d, "sources"), total)


PRIORITIES = range(1, 12)


def one_pass(name: str, share: float, before: str = "") -> str:
    """The sequential pass, one source of the registry after the other.

    Records of the test tables stay far below the cap, so it never turns a line
    away there (the brute-force tests cover that). ``before`` names the lines of an
    earlier run: their forms are not taken again, and their characters count.
    """
    was = f"select norm from c join {before} using (line_id)" if before else "select '' as norm where false"
    had = f"coalesce((select sum(n) from {before} where source = q.source), 0)" if before else "0"
    rest = f"and not exists (select 1 from c z join {before} on {before}.line_id = z.line_id where z.source = c.source and z.rec_id >= c.rec_id)" if before else ""
    parts = [f", {name}_q as (select name as source, priority, floor(quota * trunc((select sum(length(line)) from usable) * {share}))::bigint as quota, priority = max(priority) over () as is_last from sources where quota > 0), {name}_seen as ({was})"]
    done, known = [], f"select norm from {name}_seen"
    for p in PRIORITIES:
        others = " + ".join(f"coalesce((select sum(n) from {name}_{x}), 0)" for x in done) or "0"
        earlier = f" - coalesce((select sum(n) from {before}), 0)" if before else ""
        limit = f"case when q.is_last then trunc((select sum(length(line)) from usable) * {share})::bigint - ({others}){earlier} else q.quota - {had} end"
        parts.append(f""", {name}_f{p} as (select c.*, {limit} as room from c join {name}_q q on q.source = c.source where q.priority = {p} {rest} and norm not in ({known})
  qualify row_number() over (partition by norm order by line_id) = 1),
{name}_{p} as (select line_id, source, n, norm from (select *, coalesce(sum(n) over (order by line_id rows between unbounded preceding and 1 preceding), 0) as had from {name}_f{p}) where had < room)""")
        done.append(p)
        known += f" union all select norm from {name}_{p}"
    return "".join(parts) + f", {name} as (" + " union all ".join(f"select line_id, source, n from {name}_{p}" for p in PRIORITIES) + ")"


PASS = USABLE + f", c as (select line_id, rec_id, source, length(line)::bigint as n, {sql_norm('line')} as norm from usable where source is not null)"


@query("collect_exact", PASS + one_pass("taken", 0.9) + " select line_id, source, n from taken")
def collect_exact(s, d):
    return collect.collect_exact(usable(s, d), table(s, d, "sources"), total_chars(s, d, 0.9))


@query("collect_resume", PASS + one_pass("first_run", 0.3) + one_pass("more", 0.9, "first_run") + " select line_id, source, n from more")
def collect_resume(s, d):
    """A run for three tenths of the characters, gone on with to nine tenths."""
    src, u, total = table(s, d, "sources"), usable(s, d), total_chars(s, d, 1.0)
    first = collect.collect_exact(u, src, float(int(total * 0.3)))
    return collect.collect_resume(u, src, float(int(total * 0.9)), first)


@query("outcome_counts", PASS + one_pass("taken", 0.9) + f""", q as (select name as source, priority from sources where quota > 0),
l as (select clean.*, q.priority, {REASON} as reason, {sql_norm('line')} as norm from clean join q on q.source = clean.source), held as (select norm, struct_pack(p := priority, i := line_id) as who from l where line_id in (select line_id from taken)),
o as (select l.source, coalesce(reason, case when line_id in (select line_id from taken) then 'accepted' when who < struct_pack(p := priority, i := line_id) then 'dup' else 'limit' end) as outcome from l left join held on held.norm = l.norm)
select source, outcome, count(*) as lines from o group by 1, 2 union all select source, 'read', count(*) from o group by 1
union all select 'fineweb2', 'record_filtered', count(*) from fineweb2 where not ((language_score is null or language_score >= 0.90) and (minhash_cluster_size is null or minhash_cluster_size <= 1000))""")
def outcome_counts(s, d):
    src, total = table(s, d, "sources"), total_chars(s, d, 0.9)
    records = table(s, d, "fineweb2").select(F.lit("fineweb2").alias("source"), lines.is_usable().alias("kept"))
    return collect.outcome_counts(clean(s, d), src, total, collect.collect_exact(usable(s, d), src, total), records)


@query("shard_assignment", USABLE + " select line_id, source, format('{}_{:04d}', source, (row_number() over (partition by source order by line_id) - 1) // 500000 + 1) as shard from usable where source is not null")
def shard_assignment(s, d):
    return collect.shard_assignment(usable(s, d))


@query("periodic_samples", USABLE + ", r as (select line_id, source, row_number() over (partition by source order by line_id) as k from usable where source is not null) select line_id, source from r where k % 100 = 0")
def periodic_samples(s, d):
    """The distance between samples is 100 instead of 200,000 for tables of this size."""
    return collect.periodic_samples(usable(s, d), 100)


@query("old_limits", CLEAN + " select line_id, length(line) >= 10 as kept, substring(line, 1, 400) as shown from clean")
def old_limits(s, d):
    """A shorter least length without an upper limit, and lines as a report shows them."""
    c = F.col("line")
    return clean(s, d).select("line_id", (F.coalesce(T.reject_reason(c, 10, None), F.lit("")) != "length").alias("kept"), T.display(c).alias("shown"))


# ---- reports ----


@query("corpus_stats", CLEAN + """ select source, count(*) as lines, sum(length(line))::bigint as chars, count(distinct shard) as shards, count(*) filter (contains(line, chr(65533))) as bad_lines,
round(sum(length(line)) / count(*), 4) as mean_chars, round(sum(length(line)) * 100.0 / sum(sum(length(line))) over (), 4) as share from clean group by 1""")
def corpus_stats(s, d):
    return report.corpus_stats(clean(s, d))


@query("grand_totals", CLEAN + " select source, count(*) as lines, sum(length(line))::bigint as chars, grouping(source)::int as is_total from clean group by rollup (source)")
def grand_totals(s, d):
    return report.grand_totals(clean(s, d))


BUCKET_SQL = "case " + " ".join(f"when length(line) <= {hi} then '{lo}-{hi}'" for lo, hi in report.BUCKETS if hi is not None) + " else '2000+' end"


@query("length_histogram", CLEAN + f", b as (select source, {BUCKET_SQL} as bucket, count(*) as lines from clean group by 1, 2) select source, bucket, lines, round(lines * 100.0 / sum(lines) over (partition by source), 4) as percent from b")
def length_histogram(s, d):
    return report.length_histogram(clean(s, d))


TURKISH_SQL = f"length(line) - length(translate(line, '{T.TURKISH_LETTERS}', ''))"


@query("suspicious_rates", CLEAN + f""", k as (select *, row_number() over (order by line_id) as k from clean), x as (select *, string_split(line, ' ') as w from k where k % 50 = 0)
select source, count(*) as sampled, round(sum({TURKISH_SQL}) * 100.0 / nullif(sum(length(line)), 0), 4) as turkish,
round(count(*) filter (length(line) > 40 and line = upper(line) and line <> {sql_lower('line')}) * 100.0 / count(*), 4) as all_caps,
round(count(*) filter (contains(line, 'http')) * 100.0 / count(*), 4) as urls, round(count(*) filter (len(w) >= 8 and len(list_distinct(w)) < len(w) * 0.3) * 100.0 / count(*), 4) as low_variety from x group by 1""")
def suspicious_rates(s, d):
    """The systematic sample of every fiftieth line is the feature."""
    return report.suspicious_rates(report.systematic_sample(clean(s, d)))


@query("sample_lines", CLEAN + ", h as (select source, line_id, line, row_number() over (partition by source order by ('0x' || substr(sha256('draw|' || line_id), 1, 15))::bigint, line_id) as k from clean where source is not null) select source, line_id, line from h where k <= 5")
def sample_lines(s, d):
    return report.drawn_lines(clean(s, d))


@query("state_compare", CLEAN + """, s as (select trim(lower(source)) as source, arg_max(chars, struct_pack(a := saved_at, b := run_id, c := chars, d := lines)) as state_chars, arg_max(lines, struct_pack(a := saved_at, b := run_id, c := chars, d := lines)) as state_lines
  from state where chars is not null and lines is not null and source is not null group by 1),
h as (select source, count(*) as lines, sum(length(line))::bigint as chars from clean group by 1)
select coalesce(s.source, h.source) as source, coalesce(state_lines, 0) as state_lines, coalesce(lines, 0) as lines, coalesce(state_chars, 0) as state_chars, coalesce(chars, 0) as chars,
case when coalesce(state_lines, 0) = coalesce(lines, 0) and coalesce(state_chars, 0) = coalesce(chars, 0) then 'same' else 'differs' end as status from s full outer join h on s.source = h.source""")
def state_compare(s, d):
    return report.state_compare(clean(s, d), report.last_state(table(s, d, "state")))


@query("top_words", CLEAN + f" , w as (select unnest(string_split({sql_lower('line')}, ' ')) as word from clean) select word, count(*) as n from w where word <> '' group by 1 order by n desc, word limit 20")
def top_words(s, d):
    return report.top_words(clean(s, d))


@query("weird_chars", CLEAN + r""", o as (select regexp_replace(line, '[\p{L}\p{N}\s\x{1c}-\x{1f}\x{85}\p{Z}.,!?;:''"()/-]+', '', 'g') as odd from clean), c as (select unnest(string_split(odd, '')) as char from o where odd <> '')
select char, count(*) as n from c where char <> '' group by 1 order by n desc, char limit 15""")
def weird_chars(s, d):
    return report.weird_chars(clean(s, d))


@query("char_profile", CLEAN + f" select count(*) as lines, round(sum(length(line)) / count(*), 4) as mean_chars, round(sum(len(string_split(line, ' '))) / count(*), 4) as mean_words, round(sum({TURKISH_SQL}) * 100.0 / nullif(sum(length(line)), 0), 4) as turkish_percent from clean")
def char_profile(s, d):
    return report.char_profile(clean(s, d))


# ---- split ----

PLAN = USABLE + """, l as (select source, count(*) as lines from usable where source is not null group by 1),
w as (select source, lines, least(greatest(2000, round_even(lines * 100000.0 / sum(lines) over (), 0)::bigint), greatest(1, lines // 10)) as want from l),
plan as (select source, lines, want, greatest(2, round_even(lines / want, 0)::bigint) as modulo from w),
parts as (select u.line_id, u.source, u.line, case when ('0x' || substr(sha256('holdout|' || u.line), 1, 15))::bigint % p.modulo = 0 then 'holdout' else 'train' end as split from usable u join plan p on p.source = u.source)"""


@query("holdout_plan", PLAN + " select source, lines, want, modulo from plan")
def holdout_plan(s, d):
    return split.holdout_plan(usable(s, d))


def divided(s, d):
    u = usable(s, d)
    return split.holdout_split(u, split.holdout_plan(u))


@query("holdout_split", PLAN + " select line_id, source, split from parts")
def holdout_split(s, d):
    return split.holdout_draw(usable(s, d), ["line_id"])


@query("split_report", PLAN + " select source, split, count(*) as lines, sum(length(line))::bigint as chars from parts group by 1, 2")
def split_report(s, d):
    return split.split_report(divided(s, d))


# ---- pieces ----

META = CLEAN + ", pieces as (select unnest(regexp_extract_all(case when line = '' then '' else '▁' || replace(line, ' ', '▁') end, '▁[^▁]*')) as piece from clean), counts as (select piece, count(*) as n from pieces group by 1)"
BYTES = CLEAN + r""", pieces as (select unnest(regexp_extract_all(line, '''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+')) as piece from clean), counts as (select piece, count(*) as n from pieces group by 1)"""
LENGTHS = BYTES + ", lengths as (select measure, length, sum(n) as n from (select 'chars' as measure, length(piece) as length, n from counts union all select 'bytes', strlen(piece), n from counts) group by 1, 2)"


@query("metaspace_pieces", META + " select piece, n from counts")
def metaspace_pieces(s, d):
    return pieces.piece_counts(clean(s, d))


@query("byte_level_pieces", BYTES + " select piece, n from counts")
def byte_level_pieces(s, d):
    return pieces.piece_counts(clean(s, d), "byte_level")


@query("piece_lengths", LENGTHS + " select measure, length::int as length, n::bigint as n from lengths")
def piece_lengths(s, d):
    return pieces.length_counts(pieces.piece_counts(clean(s, d), "byte_level"))


@query("token_length_percentiles", LENGTHS + """, c as (select measure, length, sum(n) over (partition by measure order by length) as cum, sum(n) over (partition by measure) as total from lengths)
select measure, p as percentile, min(length)::int as length from c, (values (50.0::double), (90.0), (95.0), (99.0), (99.9), (99.99)) as v(p) where cum >= total * p / 100 group by 1, 2""")
def token_length_percentiles(s, d):
    return pieces.length_percentiles(pieces.length_counts(pieces.piece_counts(clean(s, d), "byte_level")))


@query("threshold_coverage", LENGTHS + """ select measure, t::int as threshold, coalesce(sum(n) filter (length <= t), 0)::bigint as covered, round(coalesce(sum(n) filter (length <= t), 0) * 100.0 / sum(n), 4) as percent from lengths, range(12, 41, 4) as r(t) group by 1, 2""")
def threshold_coverage(s, d):
    return pieces.threshold_coverage(pieces.length_counts(pieces.piece_counts(clean(s, d), "byte_level")))


@query("longest_pieces", BYTES + " select piece, strlen(piece)::int as bytes, n from counts order by bytes desc, piece limit 30")
def longest_pieces(s, d):
    return pieces.longest_pieces(pieces.piece_counts(clean(s, d), "byte_level"))


# ---- samples and mixtures ----

IN_SHARD = CLEAN + ", s as (select *, row_number() over (partition by source, shard order by line_no, line_id) - 1 as before from clean where source is not null and shard is not null), k as (select source, count(distinct shard) as shards from s group by 1)"


@query("head_per_shard", IN_SHARD + " select line_id, s.source, shard from s join k on k.source = s.source where before < greatest(1, 300 // shards)")
def head_per_shard(s, d):
    return sampling.head_per_shard(clean(s, d), 300)


@query("proportional_sample", IN_SHARD + """, p as (select source, greatest(1, 2000 * shards // sum(shards) over ())::bigint as source_budget, shards from k), b as (select *, greatest(1, source_budget // shards) as per_shard from p),
x as (select s.line_id, s.source, s.shard, b.source_budget from s join b on b.source = s.source where before < per_shard),
z as (select source, shard, coalesce(sum(count(*)) over (partition by source order by shard rows between unbounded preceding and 1 preceding), 0) as earlier from x group by 1, 2)
select x.line_id, x.source, x.shard from x join z on z.source = x.source and z.shard = x.shard where earlier < source_budget""")
def proportional_sample(s, d):
    return sampling.proportional_sample(clean(s, d), 2000)


def targets(s, d, share):
    """(source, target): the registry's quotas of a mix of so many times the usable characters."""
    return collect.quotas(table(s, d, "sources"), total_chars(s, d, share)).select("source", F.col("quota").alias("target"))


TARGETS = USABLE + TOTAL + ", g as (select name as source, floor(quota * (select t from total)::double)::bigint as target from sources where quota > 0)"


@query("mixture_targets", TARGETS + ", x as (select u.line_id, u.source, length(u.line)::bigint as n, g.target, coalesce(sum(length(u.line)) over (partition by u.source order by u.line_id rows between unbounded preceding and 1 preceding), 0) as before from usable u join g on g.source = u.source) select line_id, source, n from x where before < target")
def mixture_targets(s, d):
    return sampling.mixture(usable(s, d), targets(s, d, 0.5))


@query("config_mixture", TARGETS + """, k as (select distinct source, config from usable where source is not null and config is not null), w as (select *, case when config = 'memur' then 3.0::double else 1.0 end as w from k),
ct as (select w.source, config, floor(target * w / sum(w) over (partition by w.source))::bigint as target from w join g on g.source = w.source),
x as (select u.line_id, u.source, u.config, length(u.line)::bigint as n, ct.target, coalesce(sum(length(u.line)) over (partition by u.source, u.config order by u.line_id rows between unbounded preceding and 1 preceding), 0) as before from usable u join ct on ct.source = u.source and ct.config = u.config)
select line_id, source, config, n from x where before < target""")
def config_mixture(s, d):
    u = usable(s, d)
    return sampling.config_mixture(u, sampling.config_targets(u, targets(s, d, 0.5), {"memur": 3.0}))


@query("oversample", TARGETS.replace("* 0.5)", "* 2.5)") + """, x as (select u.line_id, u.source, length(u.line)::bigint as n, g.target from usable u join g on g.source = u.source), h as (select source, sum(n) as have, any_value(target) as target from x group by 1),
e as (select source, have, target, case when have > 0 and target > have then ceil((target - have) / have) else 0 end::int as epochs from h),
y as (select x.line_id, x.source, x.n, have, e.target, unnest(range(0, epochs + 1))::int as epoch from x join e on e.source = x.source),
z as (select *, coalesce(sum(n) over (partition by source, epoch order by ('0x' || substr(sha256('over|' || epoch || '|' || line_id), 1, 15))::bigint, line_id rows between unbounded preceding and 1 preceding), 0) as inn from y)
select line_id, source, epoch, n from z where epoch = 0 or inn < target - have - (epoch - 1) * have""")
def oversample(s, d):
    return sampling.oversample(usable(s, d), targets(s, d, 2.5))


@query("byte_cap", USABLE + """, a as (select line_id, source, (strlen(line) + 1)::bigint as bytes, row_number() over (partition by source order by line_id) - 1 as before from usable where source is not null),
b as (select *, coalesce(sum(bytes) over (order by line_id rows between unbounded preceding and 1 preceding), 0) as size from a where before < 400) select line_id, source, bytes from b where size < 300000""")
def byte_cap(s, d):
    """Caps of 400 lines a source and 300 kB instead of millions of lines and 5 GB, for tables of this size."""
    return sampling.byte_cap(usable(s, d), 400, 300_000)


@query("shuffle", CLEAN + " select line_id, ('0x' || substr(sha256('42|' || line_id), 1, 15))::bigint as place from clean")
def shuffle(s, d):
    return sampling.shuffled(clean(s, d)).select("line_id", "place")


@query("shuffle_chunks", CLEAN + ", p as (select line_id, ('0x' || substr(sha256('42|' || line_id), 1, 15))::bigint as place from clean) select line_id, ((row_number() over (order by place, line_id) - 1) // 1000)::bigint as chunk, place from p")
def shuffle_chunks(s, d):
    """Chunks of 1,000 lines instead of millions, for tables of this size."""
    return sampling.shuffled_chunks(clean(s, d), 1000)


# ---- vocabularies ----

OURS = vocab.vocabulary_path("byte_bpe_50k")
OTHERS = [vocab.vocabulary_path("word_bpe_49k"), vocab.vocabulary_path("piece_bpe_32k")]


def sql_vocab(path: str, name: str = "vocab") -> str:
    """The tokens of a vocabulary file, its special ones too."""
    read = f"read_json('{path}', columns = {{model: 'STRUCT(vocab MAP(VARCHAR, INTEGER), merges VARCHAR[][])', added_tokens: 'STRUCT(id INTEGER, content VARCHAR)[]'}})"
    return f"""{name} as (select e.key as token, e.value as id from (select unnest(map_entries(model.vocab)) as e from {read}) union select t.content, t.id from (select unnest(added_tokens) as t from {read})),
{name}_merges as (select m[1] as a, m[2] as b, rank from (select unnest(model.merges) as m, generate_subscripts(model.merges, 1) as rank from {read}))"""


# Byte pair encoding of the pieces in "asked": bytes are written as letters, then the pair of least rank is joined until there is none.
# A symbol stands between two marks, so that one replacement joins all places of a pair.
BPE = sql_vocab(OURS) + """,
bytes as (select b, case when p then chr(b) else chr((256 + row_number() over (partition by p order by b) - 1)::int) end as c from (select b, b between 33 and 126 or b between 161 and 172 or b between 174 and 255 as p from (select unnest(range(256))::int as b))),
letters as (select array_agg(c order by b) as m from bytes),
spelled as (select piece, chr(1) || array_to_string(list_transform(range(0, strlen(piece)), lambda i : m[('0x' || hex(encode(piece))[2 * i + 1 : 2 * i + 2])::int + 1]), chr(2) || chr(1)) || chr(2) as s from asked, letters),
steps as (select piece, s, 0 as step from spelled
  union all select piece, replace(s, chr(1) || best.a || chr(2) || chr(1) || best.b || chr(2), chr(1) || best.a || best.b || chr(2)), step + 1
  from (select p.piece, p.s, p.step, arg_min(struct_pack(a := m.a, b := m.b), m.rank) as best
    from (select piece, s, step, unnest(list_zip(x[:-2], x[2:])) as xy from (select piece, s, step, string_split(s[2:-2], chr(2) || chr(1)) as x from steps)) p join vocab_merges m on m.a = p.xy[1] and m.b = p.xy[2] group by all)),
tokens as (select piece, generate_subscripts(t, 1) as k, unnest(t) as token from (select piece, string_split(arg_max(s, step)[2:-2], chr(2) || chr(1)) as t from steps group by piece)),
bpe as (select piece, array_agg(v.id order by k) as ids from tokens join vocab v on v.token = tokens.token group by piece)"""
BYTE_PIECES = r"regexp_extract_all({}, '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+')"
RECURSIVE = USABLE.replace("with clean", "with recursive clean", 1)
ENCODED = RECURSIVE + f""", parts as (select line_id, source, generate_subscripts(p, 1) as place, unnest(p) as piece from (select line_id, source, {BYTE_PIECES.format('line')} as p from usable)), asked as (select distinct piece from parts), """ + BPE
# Words (with a blank before them) and their pieces; "whole" has the number of tokens of each.
WORDS = f""", running as (select unnest(string_split({sql_lower('line')}, ' ')) as word from usable), words as (select word, count(*) as n from running where word <> '' group by 1),
parts as (select word, unnest({BYTE_PIECES.format("' ' || word")}) as piece from words), asked as (select distinct piece from parts), """ + BPE + ", whole as (select word, sum(len(ids))::int as tokens from parts join bpe on bpe.piece = parts.piece group by 1)"
PLAIN_TOKEN = "regexp_replace(token, '^[Ġ▁]|</w>$', '')"


@query("encode", ENCODED + " select line_id, flatten(array_agg(ids order by place)) as ids from parts join bpe on bpe.piece = parts.piece group by 1")
def encode(s, d):
    return usable(s, d).select("line_id", vocab.encode(F.col("line"), OURS).alias("ids"))


@query("decode", USABLE + " select line_id, line from usable")
def decode(s, d):
    """There and back: the decoded lines must be the lines."""
    x = usable(s, d).select("line_id", vocab.encode(F.col("line"), OURS).alias("ids"))
    return x.select("line_id", vocab.decode(F.col("ids"), OURS).alias("line"))


@query("vocab_profile", "with " + sql_vocab(OURS) + f""", f as (select token, contains(token, 'http') or contains(token, '.com') or contains(token, '.aspx') or contains(token, '?') or contains(token, '=') as url, regexp_matches(token, '[{T.TURKISH_LETTERS}]') as tr from vocab)
select count(*) as tokens, sum(url::int)::bigint as url_like, round(sum(url::int) * 100.0 / count(*), 4) as url_percent, sum(tr::int)::bigint as turkish, round(sum(tr::int) * 100.0 / count(*), 4) as turkish_percent, max(length(token))::int as longest from f""")
def vocab_profile(s, d):
    return vocab.vocab_profile(vocab.vocab_table(s, OURS))


@query("long_words", "with " + sql_vocab(OURS) + f", w as (select id, {PLAIN_TOKEN} as word from vocab) select id, word, length(word)::int as length from w where regexp_full_match(word, '\\p{{L}}{{6,}}') order by length(word) desc, word, id limit 20")
def long_words(s, d):
    return vocab.long_words(vocab.vocab_table(s, OURS))


@query("vocab_samples", "with " + sql_vocab(OURS) + " select id, token from vocab where id between 500 and 519 or id between 10000 and 10019 or id between 50240 and 50259")
def vocab_samples(s, d):
    return vocab.id_samples(vocab.vocab_table(s, OURS), [500, 10_000, 50_240])


@query("vocab_mapping", "with " + sql_vocab(OURS) + ", " + sql_vocab(OTHERS[0], "other") + " select vocab.id as old_id, other.id as new_id, vocab.token from vocab join other on other.token = vocab.token")
def vocab_mapping(s, d):
    return vocab.vocab_mapping(vocab.vocab_table(s, OURS), vocab.vocab_table(s, OTHERS[0]))


@query("token_frequency", RECURSIVE + f""", marked as (select unnest(regexp_extract_all('▁' || replace(line, ' ', '▁'), '▁[^▁]*')) as piece from usable), counts as (select piece, count(*) as n from marked group by 1),
parts as (select c.piece as whole, n, unnest({BYTE_PIECES.format("regexp_replace(c.piece, '^▁', ' ')")}) as piece from counts c), asked as (select distinct piece from parts), """ + BPE + " select id as token_id, sum(n)::bigint as n from (select n, unnest(ids) as id from parts join bpe on bpe.piece = parts.piece) group by 1")
def token_frequency(s, d):
    return vocab.token_frequency(pieces.piece_counts(usable(s, d)), OURS)


@query("fertility", ENCODED + """, t as (select source, sum(len(ids))::bigint as tokens from parts join bpe on bpe.piece = parts.piece where source is not null group by 1),
l as (select source, count(*) as lines, sum(len(string_split(line, ' ')))::bigint as words, sum(length(line)) as chars from usable where source is not null group by 1)
select l.source, lines, words, tokens, round(tokens / words, 4) as fertility, round(chars / tokens, 4) as chars_per_token from l join t on t.source = l.source""")
def fertility(s, d):
    return vocab.fertility(usable(s, d), OURS)


@query("continued_words", RECURSIVE + WORDS + ", c as (select sum(n)::bigint as words, coalesce(sum(n) filter (tokens > 1), 0)::bigint as continued from words join whole on whole.word = words.word) select *, round(continued * 100.0 / words, 4) as percent from c")
def continued_words(s, d):
    return vocab.continued_words(report.word_counts(usable(s, d)), OURS)


@query("register_eval")
def register_eval(s, d):
    return vocab.register_eval(usable(s, d), OURS, OTHERS)


@query("learned_words", RECURSIVE + WORDS + " select word, tokens, tokens <= 3 as learned from whole")
def learned_words(s, d):
    return vocab.learned_words(report.word_counts(usable(s, d)), OURS)


LONGEST = 128


@query("validation", USABLE + f""", n as (select count(*) as n from usable), {sql_vocab(OURS)}, v as (select count(*) as n, count(*) filter (length(token) <= {LONGEST}) as short from vocab)
select c as "check", p as passed, f as failed, b as blocking from (
  select 'round trip' as c, n as p, 0::bigint as f, false as b from n union all select 'letter case', n, 0, false from n union all select 'no unknown token', n, 0, true from n union all select 'load', n, 0, true from n
  union all select 'exotic texts', {len(vocab.EXOTIC)}, 0, false union all select 'special ids', 1, 0, true union all select 'ids without gaps', 1, 0, true union all select 'token length', short, n - short, true from v)""")
def validation(s, d):
    return vocab.validation(usable(s, d).select(F.col("line").alias("text")), vocab.vocab_table(s, OURS), OURS, {"<|endoftext|>": 50256}, LONGEST)


@query("capacity_plan", """with p(vocab, ram_mb, seconds) as (values (8000, 420.0::double, 31.0::double), (16000, 466.0, 40.0), (32000, 546.0, 55.0)), l as (select (546.0 - 420.0) / 24000 as m, (55.0 - 31.0) / 24000 as t)
select 128000 as target, round(420.0::double + m * 120000, 3) as ram_mb, round(31.0::double + t * 120000, 3) as seconds, round((420.0::double + m * 120000) * 1.3, 3) as needed_mb,
round(abs(466.0 - (420.0::double + m * 8000)) / (420.0::double + m * 8000) * 100, 3) as deviation, false as warn, 'standard' as verdict from l""")
def capacity_plan(s, d):
    """Three made-up measuring points; the formula is what is compared."""
    points = s.createDataFrame([(8000, 420.0, 31.0), (16000, 466.0, 40.0), (32000, 546.0, 55.0)], "vocab int, ram_mb double, seconds double")
    return vocab.capacity_plan(points, 128_000)


# ---- streaming ----


@query("stream_collect", USABLE + f" select min(line_id) as line_id from usable group by {sql_norm('line')}")
def stream_collect(s, d):
    """The table as a stream of files: lines that nobody had before."""
    import os
    import uuid

    from textloom.streaming.collect import collect_stream

    path = f"{d}/shards.parquet"
    at = f"{shared_dir(s)}/textloom/stream-{uuid.uuid4().hex}"
    schema = s.read.parquet(path).schema
    folder, glob = (path, None) if os.path.isdir(path) else (d, "shards.parquet")
    return collect_stream(s, folder, schema, f"{at}/accepted", f"{at}/checkpoint", glob).select("line_id")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
