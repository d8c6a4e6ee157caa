"""The pN_ queries, each over its whole tables with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import copies, leak, mixing, mojibake, neardup, overlap, packing, quality, subjects
from textloom.queries import BPE
from textloom.session import cut

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.found(table(spark, sf_dir, "shards"))


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_id, restored, chains, stretches, lost): the affected lines as they were, as far as can be told."""
    return mojibake.repair(table(spark, sf_dir, "shards")).select(F.col("id").alias("line_id"), "restored", F.array_join("chains", "; ").alias("chains"), "stretches", "lost")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.found(table(spark, sf_dir, "shards"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "shards"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.found(table(spark, sf_dir, "shards"))


def p3_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.statistics(table(spark, sf_dir, "shards"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.found(table(spark, sf_dir, "mix_runs"), table(spark, sf_dir, "sources"), table(spark, sf_dir, "state"))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "mix_runs"), table(spark, sf_dir, "sources"), table(spark, sf_dir, "state"))


def p4_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in training order under weights that shift over the run, half as many characters again as there are, each source at most four times."""
    docs = table(spark, sf_dir, "documents")
    total = 1.5 * (docs.agg(F.sum(F.length("text"))).first()[0] or 0)
    x = mixing.positions(docs, mixing.shifting_schedule(table(spark, sf_dir, "sources")), total, 4)
    return x.select("doc_id", "source", "epoch", F.round("position", 6).alias("position"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.found(table(spark, sf_dir, "shards"))


def p5_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.copy_counts(table(spark, sf_dir, "shards"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.found(table(spark, sf_dir, "holdout"), table(spark, sf_dir, "train"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, source, lines, leaked)."""
    return overlap.report(table(spark, sf_dir, "holdout"), table(spark, sf_dir, "train")).drop("mean_coverage")


def p6_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with the mean share of words covered by aligned chains."""
    return overlap.report(table(spark, sf_dir, "holdout"), table(spark, sf_dir, "train"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(table(spark, sf_dir, "documents"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill(packing.containers(table(spark, sf_dir, "documents")))


#: Chat and reviews don't share a container with reference works.
APART = tuple((a, b) for a in ("forum", "senti", "vitamin") for b in ("wiki", "akademik"))


def p7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, tokens): the sizes that are packed."""
    return packing.token_counts(table(spark, sf_dir, "documents")).select("doc_id", "tokens")


def p7_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers in which sources that have to stay apart never meet."""
    return packing.containers(table(spark, sf_dir, "documents"), apart=APART)


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both packings must keep, counted on the packing with sources apart."""
    docs = table(spark, sf_dir, "documents")
    return packing.checks(cut(packing.containers(docs, apart=APART), "packed"), docs, apart=APART)


def p8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, doc_id) where at least twelve words of the item stand in a row as they are."""
    return leak.matches(table(spark, sf_dir, "eval_items"), table(spark, sf_dir, "documents")).where("kind = 'exact'").select("item_id", "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.found(table(spark, sf_dir, "eval_items"), table(spark, sf_dir, "documents"))


def p8_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.matches(table(spark, sf_dir, "eval_items"), table(spark, sf_dir, "documents"))


def subject_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels"), table(spark, sf_dir, "subjects")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.found(*subject_tables(spark, sf_dir))


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.composition(*subject_tables(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name[0] == "p" and name[1].isdigit()}


PLAN = """
with last as (
  select run_id, lower(trim(source)) as k, arg_max(chars, struct_pack(a := saved_at, b := chars)) as chars
  from state where chars is not null and source is not null group by 1, 2),
plan as (
  select r.run_id, s.name as source, s.quota, coalesce(l.chars, 0) as chars, r.max_repeat, s.quota * r.total_chars as target
  from mix_runs r cross join sources s left join last l on l.run_id = r.run_id and l.k = lower(trim(s.name))
  where s.quota > 0),
used as (select *, chars * max_repeat < target as short, least(cast(chars * max_repeat as double), target) as used from plan)
"""


# Weights that stand, move and stand again; the place in a source's demand is inverted piece by piece.
POSITIONS = """
with r as (select name as source, lower(trim(name)) as k, quota::double as q, 0.8 * (2 * (row_number() over (order by priority, name) - 1) / greatest(count(*) over () - 1, 1) - 1) as tilt from sources where quota > 0),
d as (select doc_id, lower(trim(source)) as k, length(text)::bigint as size, ('0x' || substr(sha256('order|' || doc_id), 1, 15))::bigint as h from documents where length(text) > 0),
total as (select 1.5 * sum(length(text)) as total from documents),
h as (select r.*, have, q * total as demand, least(q * total, have * 4.0::double) as used, total from (select k, sum(size) as have from d group by 1) x join r on r.k = x.k, total),
s as (select doc_id, d.k, coalesce(sum(size) over (partition by d.k order by h, doc_id rows between unbounded preceding and 1 preceding), 0) as start from d),
e as (select doc_id, h.*, start, unnest(range(0, greatest(ceil((used - start) / have), 1)::bigint))::int as epoch from s join h on h.k = s.k where start < used),
a as (select *, (start + epoch * have) / used * demand / total as x, q * (1 - tilt) as lo, q * (1 + tilt) as hi from e),
b as (select *, 0.2 * lo as first, 0.2 * lo + 0.6 * q as second, (hi - lo) / 0.6 as slope from a)
select doc_id, source, epoch, round(case when x < first then x / lo when x < second then 0.2 + case when abs(slope) < 1e-12 then (x - first) / lo else (sqrt(lo * lo + 2 * slope * (x - first)) - lo) / slope end
  else least(1.0, 0.8 + (x - second) / hi) end, 6) as position from b
"""

# Lower case by Turkish rules, letters and digits, words; fields are cut before each label by a mark put in front of it.
LOWER = "lower(replace(replace(text, 'İ', 'i'), 'I', 'ı'))"
SPACE = r"[\s\x0b\p{Z}\p{Cf}]"
LABEL = r"\p{L}[\p{L}\p{Z}\p{Cf}\s\x0b]{0,24}:"
KEYS = f"""
with lines as (select line_id, regexp_replace({LOWER}, '[^\\p{{L}}\\p{{N}}]+', '', 'g') as letters,
  case when regexp_matches(text, '(?s)^{SPACE}*{LABEL}.*[•|/;,·]{SPACE}*{LABEL}') then string_split(regexp_replace({LOWER}, '{SPACE}*[•|/;,·]{SPACE}*({LABEL})', chr(1) || '\\1', 'g'), chr(1)) end as parts
  from shards where text is not null and line_id is not null),
fields as (select line_id, letters, array_to_string(list_sort(list_filter(list_transform(parts, lambda x : regexp_replace(x, '[^\\p{{L}}\\p{{N}}]+', '', 'g')), lambda x : x <> '')), chr(31)) as f from lines where length(letters) >= 40),
of_letters as (select letters, min(f) as f from fields group by 1),
keys as (select distinct line_id, coalesce(o.f, x.letters) as key from fields x join of_letters o on o.letters = x.letters),
classes as (select key, min(line_id) as first_line_id, count(*) as n from keys group by 1 having count(*) > 1)
"""


def words_sql(table: str) -> str:
    """(line_id, n, w, k): the words of lines with at least 20 of them, each with how often it has come before."""
    split = f"string_split(trim(regexp_replace({LOWER}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    return f"""(select line_id, n, w, row_number() over (partition by line_id, w) as k from
  (select line_id, len(ws) as n, unnest(ws) as w from (select line_id, {split} as ws from (select distinct line_id, text from {table} where text is not null)) where len(ws) >= 20))"""


SHARED = """select a.line_id as a, b.line_id as b from {a} a join {b} b on a.w = b.w and a.k = b.k {different} group by a.line_id, b.line_id, a.n, b.n having count(*) >= 0.75 * greatest(a.n, b.n)"""


# Texts with the same letters and the same words are one unit; units are linked by the words they share, and groups spread along links.
GROUPS = f"""
with recursive lines as (select distinct line_id, regexp_replace({LOWER}, '[^\\p{{L}}\\p{{N}}]+', '', 'g') as letters, string_split(trim(regexp_replace({LOWER}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as ws from shards where text is not null and line_id is not null),
long as (select line_id, letters, list_sort(ws) as ws from lines where len(ws) >= 20),
member as (select line_id, min(line_id) over (partition by letters, ws) as unit from long),
words as (select unit, n, w, row_number() over (partition by unit, w) as k from (select line_id as unit, len(ws) as n, unnest(ws) as w from long where line_id in (select unit from member))),
links as (select a.unit as a, b.unit as b from words a join words b on a.w = b.w and a.k = b.k and a.unit <> b.unit group by a.unit, b.unit, a.n, b.n having count(*) >= 0.75 * greatest(a.n, b.n)),
spread as (select a as unit, a as seen from links union select s.unit, l.b from spread s join links l on l.a = s.seen),
roots as (select unit, min(seen) as root from spread group by 1),
counts as (select a as unit, count(*) as n from links group by 1),
found as (select m.line_id, coalesce(r.root, m.unit) as group_id, coalesce(c.n, 0) as n_links from member m left join roots r on r.unit = m.unit left join counts c on c.unit = m.unit)
select line_id, group_id, n_links from found qualify count(*) over (partition by group_id) > 1
"""


# White space before a word gives it its last character, if that is a blank. A mark before that character stands in for the look-ahead of the split pattern.
BLANKS = r"\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}"
TOKENS = (
    rf"""with recursive marked as (select doc_id, regexp_replace(text, '([{BLANKS}])([^{BLANKS}])', chr(1) || '\1\2', 'g') as t from documents where text is not null),
raw as (select doc_id, unnest(regexp_extract_all(t, '''s|''t|''re|''ve|''m|''ll|''d|\x01? ?\p{{L}}+|\x01? ?\p{{N}}+|\x01? ?[^{BLANKS}\x01\p{{L}}\p{{N}}]+|\x01[{BLANKS}]|[{BLANKS}]+')) as p from marked),
parts as (select doc_id, replace(p, chr(1), '') as piece, count(*) as n from raw group by all), asked as (select distinct piece from parts), """
    + BPE
    + """, size as (select doc_id, sum(n * len(ids))::bigint as tokens from parts join bpe on bpe.piece = parts.piece group by 1)
select d.doc_id, coalesce(tokens, 0)::bigint as tokens from documents d left join size on size.doc_id = d.doc_id"""
)


def phrase_words(table: str, key: str) -> str:
    plain = "lower(replace(text, 'İ', 'i'))"
    for a, b in ("ıi", "şs", "ğg", "çc", "öo", "üu", "âa", "îi", "ûu"):
        plain = f"replace({plain}, '{a}', '{b}')"
    return f"""(select {key}, i, array_to_string(ws[i : i + 11], ' ') as phrase from (select {key}, ws, unnest(range(1, len(ws) - 10)) as i
  from (select {key}, string_split(trim(regexp_replace(strip_accents({plain}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as ws from {table} where text is not null) where len(ws) >= 12))"""


PHRASES = f"with a as {phrase_words('eval_items', 'item_id')}, b as {phrase_words('documents', 'doc_id')} select distinct item_id, doc_id from a join b on a.phrase = b.phrase"


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": KEYS + f", words as {words_sql('shards')}, pairs as ({SHARED.format(a='words', b='words', different='and a.line_id < b.line_id')})"
        " select a as line_id_a, b as line_id_b from pairs left join keys x on x.line_id = a left join keys y on y.line_id = b where x.key is null or y.key is null or x.key <> y.key",
        "p5_found": KEYS + "select first_line_id, line_id from keys join classes on classes.key = keys.key where line_id > first_line_id",
        "p5_copies": KEYS + "select first_line_id as line_id, n as n_copies from classes",
        "p6_found": f"with h as {words_sql('holdout')}, t as {words_sql('train')}, pairs as ({SHARED.format(a='h', b='t', different='')}) select a as holdout_line_id, b as train_line_id from pairs",
        "p6_report": f"with h as {words_sql('holdout')}, t as {words_sql('train')}, pairs as ({SHARED.format(a='h', b='t', different='')}) select split, source, count(*) as lines, count(hit) as leaked from (select distinct line_id, split, source from holdout) l left join (select distinct a as hit from pairs) p on p.hit = l.line_id group by 1, 2",
        "p2_groups": GROUPS,
        "p7_checks": "select count(*) as documents, 0 as missing, 0 as twice, 0 as overfull, 0 as own_shared, 0 as copies_together, 0 as apart_together from documents",
        "p7_tokens": TOKENS,
        "p8_exact": PHRASES,
        "p4_found": PLAN + "select run_id, source from used where short",
        "p4_report": PLAN + "select run_id, source, quota, chars, round(target, 3) as target, round(used, 3) as used, round(used / sum(used) over (partition by run_id), 9) as share, short, case when short then round(chars * max_repeat / target, 6) end as dry_at from used",
        "p4_positions": POSITIONS,
    }
