"""Registry of the core's queries and their SQL. A query takes (spark, folder) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import adapters as A
from tamis.functions import classify as C
from tamis.functions import formats
from tamis.functions import messages as M
from tamis.functions import text as T
from tamis.operators import audit, budget, dedup, integrity, mixture, profile, sampling, validate
from tamis.sources import synthetic, writers
from tamis.session import spread
from tamis.spec import MixtureSpec, RetentionSpec, Schema
from tamis.streaming import ingest
from tamis.tables import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

# --- SQL fragments -------------------------------------------------------------------------------
_WS = r"[\t\n\x0B\f\r \x{85}\p{Z}]"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _collapse(x: str) -> str:
    return _strip(rf"regexp_replace({x}, '{_WS}+', ' ', 'g')")


def _or_empty(x: str) -> str:
    return f"coalesce({x}, '')"


def _list(xs) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


def _markers(x: str, xs) -> str:
    return f"len(list_filter([{_list(dict.fromkeys(xs))}], lambda k: contains({x}, k)))"


def _hits(x: str, xs) -> str:
    return rf"len(list_filter(regexp_split_to_array({x}, '[^\p{{L}}\p{{N}}\p{{M}}_]+'), lambda w: w in ({_list(xs)})))"


def _chars(x: str, cls: str) -> str:
    return f"length(regexp_replace({x}, '[^{cls}]', '', 'g'))"


_NORM = _strip(r"regexp_replace(lower(text), '[^\p{L}\p{N}_" + _WS[1:-1] + r"]', '', 'g')")
_NO_BOM = "replace(text, chr(65279), '')"
_EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]"
_NOT_WS = "[^" + _WS[1:-1] + "]"
_WEB = f"regexp_replace(regexp_replace(text, 'https?://{_NOT_WS}+|www[.]{_NOT_WS}+', '', 'g'), '{_EMOJI}', '', 'g')"
_EST = "(case when coalesce(length({0}), 0) = 0 then 0 else greatest(1, length({0}) // 4) end)"
_TOTAL = f"coalesce(list_sum(list_transform(messages, lambda m: {_EST.format('m.content')} + 1)), 0)"
_ASSIST = f"coalesce(list_sum(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: {_EST.format('m.content')})), 0)"
_CHARS = "coalesce(list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))), 0)"
_LAST_USER = "coalesce(list_filter(messages, lambda m: m.role = 'user')[-1].content, '')"
_SYSTEM = "coalesce(list_filter(messages, lambda m: m.role = 'system')[1].content, '')"
_KEY = "sha256('42:' || {0}::varchar)"
_ARABIC = r"\x{600}-\x{6FF}"


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def docs(spark, d):
    return table(spark, d, "documents")


def derja(spark, d):
    return table(spark, d, "arabic_derja")


def dear(df, *columns):
    """The columns that dear expressions need, on all cores: a small file would keep one busy; a table of many parts stays as it is."""
    return spread(df.select(*columns))


# --- profiles ------------------------------------------------------------------------------------
@query("with g as (select lang, count(*) as records, sum(coalesce(length(text), 0)) as chars, sum(case when coalesce(length(text), 0) = 0 then 0 else greatest(1, length(text) // 4) end) as approx_tokens from documents group by lang) select lang, records, chars::bigint as chars, approx_tokens::bigint as approx_tokens, chars / sum(chars) over () as char_share from g")
def profile_by_language(spark, d):
    g = docs(spark, d).groupBy("lang").agg(F.count(F.lit(1)).alias("records"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars"), F.sum(T.token_estimate(F.col("text"))).alias("approx_tokens"))
    total = g.agg(F.sum("chars").alias("t"))
    return g.crossJoin(F.broadcast(total)).withColumn("char_share", F.col("chars") / F.col("t")).drop("t")


@query("select coalesce(source, 'None') as value, count(*) as n from documents group by 1 order by n desc, value limit 20")
def profile_by_source_top20(spark, d):
    return profile.counts(docs(spark, d), F.col("source"), 20)


_FIELDS = ["category", "source", "language", "script", "difficulty"]


@query(" union all ".join(f"select '{c}' as field, coalesce({c}, 'None') as value, count(*) as n from arabic_derja group by 2" for c in _FIELDS))
def record_distributions(spark, d):
    return profile.distributions(derja(spark, d), _FIELDS)


@query(f"with b as (select id, greatest(coalesce(len(messages), 0), 0) as turns, {_CHARS} as chars, coalesce(code_switching, false) as cs from arabic_derja), dd as (select coalesce(sum(n - 1), 0)::bigint as duplicate_ids from (select count(*) as n from b where id is not null and id <> '' group by id having count(*) > 1)) select count(*) as examples, avg(turns) as avg_messages, avg(chars) as avg_chars, min(chars)::bigint as min_chars, max(chars)::bigint as max_chars, (sum(chars) // 4)::bigint as approx_tokens, count_if(cs) as code_switching, any_value(duplicate_ids) as duplicate_ids from b, dd")
def dataset_profile(spark, d):
    return profile.dataset_profile(derja(spark, d))


@query(f"with g as (select language, category, count(*) as examples, sum({_TOTAL})::bigint as tokens from arabic_derja group by all) select *, coalesce(tokens / sum(tokens) over (), 0) as token_share from g")
def audit_by_language_category(spark, d):
    return profile.audit(derja(spark, d), ["language", "category"], M.tokens_total(F.col("messages")))


@query("with s as (select lang, list_sort(list(length(text))) as v, count(text) as n from documents where text is not null group by lang) select lang, n, v[floor(n * 0.5)::int + 1] as median, v[floor(n * 0.9)::int + 1] as p90, v[floor(n * 0.95)::int + 1] as p95, v[floor(n * 0.99)::int + 1] as p99, v[1] as least, v[-1] as most from s")
def length_percentiles(spark, d):
    return profile.order_statistics(docs(spark, d), F.length("text"), {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}, ["lang"])


@query(f"select count(*) as rows, count_if(t > 128) as over_128, count_if(t > 512) as over_512, count_if(t > 2048) as over_2048 from (select {_TOTAL} as t from arabic_derja)")
def length_thresholds(spark, d):
    return profile.exceedance(derja(spark, d), M.tokens_total(F.col("messages")), [128, 512, 2048])


@query("select language, count(*) as rows, count_if(split = 'train') as n_train, count_if(split = 'val') as n_val, count_if(split = 'test') as n_test, count_if(split = 'train') / count(*) as share_train, count_if(split = 'val') / count(*) as share_val, count_if(split = 'test') / count(*) as share_test from arabic_derja group by language")
def language_split_crosstab(spark, d):
    return profile.crosstab(derja(spark, d), "language", "split", ["train", "val", "test"])


@query("with n as (select source, count(*) as n from arabic_derja group by source), a as (select m.source, m.target_share as share, coalesce(n.n, 0) as n from mixture_targets m left join n using (source)), b as (select *, n / sum(n) over () as actual from a) select source, share, n, actual, case when actual - share > 0.01 then 'OVER' when actual - share < -0.01 then 'UNDER' else 'OK' end as status from b")
def share_status(spark, d):
    return profile.shares(derja(spark, d), "source", table(spark, d, "mixture_targets").select("source", F.col("target_share").alias("share")))


@query("with g as (select text, count(*) as n from documents where text is not null group by text) select count(*) as groups, sum(n)::bigint as rows, max(n) as largest, coalesce(sum(case when n > 1 then n end), 0)::bigint as rows_in_groups from g")
def passage_groups(spark, d):
    return profile.group_sizes(docs(spark, d).where("text is not null"), F.col("text"))


@query("with g as (select count(*) as n from documents where text is not null group by sha256(text) having count(*) > 1) select count(*) as groups, coalesce(sum(n), 0)::bigint as rows from g")
def exact_dup_groups(spark, d):
    return profile.duplicate_groups(docs(spark, d).where("text is not null"), [T.sha256(F.col("text"))])


@query(f"with g as (select count(*) as n from raw_dialect_qa group by {_strip('coalesce(instruction, chr(0))')}, {_strip('coalesce(output, chr(0))')} having count(*) > 1) select count(*) as groups, coalesce(sum(n), 0)::bigint as rows from g")
def pair_dups(spark, d):
    q = table(spark, d, "raw_dialect_qa")
    return profile.duplicate_groups(q, [T.strip(F.coalesce(c, F.lit("\0"))) for c in ("instruction", "output")])


@query("select code, count(*) as n from record_errors group by code")
def error_log_counts(spark, d):
    return validate.code_counts(table(spark, d, "record_errors"))


@query("select coalesce(field, 'None') as value, count(*) as n from record_errors group by 1")
def error_field_counts(spark, d):
    return profile.counts(table(spark, d, "record_errors"), F.col("field"))


@query(f"select substr(sha256({_SYSTEM}), 1, 16) as template, count(*) as n, min(left({_SYSTEM}, 80)) as preview from arabic_derja group by 1")
def template_inventory(spark, d):
    m = F.col("messages")
    return profile.template_inventory(derja(spark, d), M.template_key(m), M.first_of(m, "system"))


@query(f"with a as (select count(*) as source_rows, sum({_TOTAL})::bigint as source_tokens from arabic_derja), b as (select count(*) as rows, sum({_TOTAL})::bigint as tokens from arabic_derja where split = 'train') select *, (source_rows - rows) * 100.0::double / source_rows as rows_pct, (source_tokens - tokens) * 100.0::double / source_tokens as tokens_pct from a, b")
def reduction(spark, d):
    r = derja(spark, d)
    return profile.reduction(r, r.where("split = 'train'"), M.tokens_total(F.col("messages")))


@query("select c.source, c.license_status, c.expected_rows, coalesce(n.n, 0) as rows, round(coalesce(n.n, 0) * 100.0::double / nullif(c.expected_rows, 0), 2) as completion_pct from source_catalog c left join (select source, count(*) as n from arabic_derja group by source) n using (source)")
def source_inventory(spark, d):
    n = derja(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    out = table(spark, d, "source_catalog").join(n, "source", "left").withColumn("rows", F.coalesce("n", F.lit(0)))
    return out.select("source", "license_status", "expected_rows", "rows", F.round(F.try_divide(F.col("rows") * 100.0, F.col("expected_rows")), 2).alias("completion_pct"))


@query("select count(*) as rows, count(distinct d.source) as sources from documents d semi join (select source from source_catalog where license_status in ('APPROVED', 'CONDITIONAL')) c on c.source = d.source")
def license_gate(spark, d):
    ok = table(spark, d, "source_catalog").where(F.col("license_status").isin("APPROVED", "CONDITIONAL")).select("source")
    return docs(spark, d).join(ok, "source", "left_semi").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("source").alias("sources"))


# --- text expressions ----------------------------------------------------------------------------
@query(f"select doc_id, md5({_collapse('text')}) as collapsed, md5({_collapse(_NO_BOM)}) as clean, md5({_NORM}) as norm from documents")
def clean_text(spark, d):
    t = F.col("text")
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", F.md5(T.collapse(t)).alias("collapsed"), F.md5(T.clean_bom(t)).alias("clean"), F.md5(T.norm_key(t)).alias("norm"))


@query(f"select doc_id, md5({_collapse(_WEB)}) as web from documents")
def clean_web_text(spark, d):
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", F.md5(T.clean_web(F.col("text"))).alias("web"))


@query(f"select doc_id, coalesce({_chars('text', _ARABIC)}, 0) as arabic, coalesce({_chars('text', 'A-Za-z')}, 0) as latin, coalesce({_chars('text', '379')}, 0) as digits from documents")
def char_class_counts(spark, d):
    t = F.col("text")
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", T.count_chars(t, T.ARABIC_CHAR).alias("arabic"), T.count_chars(t, T.LATIN_CHAR).alias("latin"), T.count_chars(t, T.ARABIZI_DIGIT).alias("digits"))


@query(f"select doc_id, coalesce({_markers('text', C.MSA_MARKERS)}, 0) as msa, coalesce({_markers('lower(text)', C.FRENCH_MARKERS)}, 0) as french, coalesce({_markers('lower(text)', C.TUNISIAN_MARKERS)}, 0) as tunisian from documents")
def marker_counts(spark, d):
    t = F.col("text")
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", T.count_markers(t, C.MSA_MARKERS).alias("msa"), T.count_markers(F.lower(t), C.FRENCH_MARKERS).alias("french"), T.count_markers(F.lower(t), C.TUNISIAN_MARKERS).alias("tunisian"))


@query(f"select line_no, {_TOTAL}::bigint as tokens_total, {_ASSIST}::bigint as tokens_assistant, {_CHARS}::bigint as chars from arabic_derja")
def token_estimate(spark, d):
    m = F.col("messages")
    return derja(spark, d).select("line_no", M.tokens_total(m).alias("tokens_total"), M.tokens_assistant(m).alias("tokens_assistant"), M.record_chars(m).alias("chars"))


_FRENCH_RE = "(?i)(^|[^\\p{L}\\p{N}\\p{M}_])(" + "|".join(dict.fromkeys(T.FRENCH_WORDS)) + ")($|[^\\p{L}\\p{N}\\p{M}_])"


@query(f"select doc_id, coalesce(regexp_matches(text, '[{_ARABIC}]'), false) as arabic, coalesce(regexp_matches(text, '{_FRENCH_RE}'), false) as french, length({_strip(_or_empty('text'))}) < 10 as short, coalesce(length({_strip('text')}) >= 2, false) as valid, coalesce(regexp_matches(text, '[379]'), false) as digits from documents")
def text_filters(spark, d):
    t = F.col("text")
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", T.has_arabic(t).alias("arabic"), T.has_french(t).alias("french"), T.is_short(t).alias("short"), T.is_valid_text(t).alias("valid"), T.has_digit_orthography(t).alias("digits"))


# --- classifiers ---------------------------------------------------------------------------------
_A, _L = _chars("text", _ARABIC), _chars("text", "A-Za-z")


@query(f"select doc_id, case when {_A} > 0 and {_L} > 0 then 'tunisian_mixed_script' when {_A} > 0 then 'tunisian_arabic_script' when {_L} > 0 and not ({_chars('text', '379')} = 0 and {_markers('lower(text)', C.TUNISIAN_MARKERS)} = 0 and len(list_intersect(regexp_split_to_array(lower(text), '{_WS}+'), [{_list(C.FRENCH_COMMON)}])) > 2) then 'tunisian_arabizi' else 'non_tunisian_or_uncertain' end as label from documents")
def classify_script(spark, d):
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", C.classify_script(F.col("text")).alias("label"))


@query(f"select doc_id, case when {_A} > 0 and {_L} > 0 then 'mixed_script' when {_A} > 0 then 'arabic_script' when {_L} > 0 then 'arabizi' else 'uncertain' end as label from documents")
def detect_script(spark, d):
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", C.detect_script(F.col("text")).alias("label"))


#: The same words as whole tokens; one of them stands with and without its doubling.
_DIALECT = [w for w in C.DIALECT_WORDS if "?" not in w] + ["نحب", "نحبّ"]


@query(f"with s as (select doc_id, coalesce({_markers('text', C.MSA_MARKERS)} + {_markers('text', C.MSA_QUESTION_WORDS)}, 0) as msa_score, coalesce({_hits('text', _DIALECT)}, 0) as dialect_score, coalesce({_A}, 0) as arabic_chars, coalesce({_L}, 0) as latin_chars from documents) select *, case when latin_chars > arabic_chars * 0.5 and latin_chars > 10 then 'latin_or_code_switched' when arabic_chars < 30 and latin_chars < 10 then 'other' when dialect_score >= 2 and dialect_score > msa_score then 'dialect' when msa_score >= 1 and dialect_score <= 1 then 'msa' when msa_score >= 1 and dialect_score >= 2 then 'mixed' when msa_score = 0 and dialect_score = 0 then case when arabic_chars >= 30 then 'msa' else 'other' end else 'mixed' end as label from s")
def classify_register(spark, d):
    names = ("msa_score", "dialect_score", "arabic_chars", "latin_chars")
    s = C.register_signals(F.col("text"))
    told = dear(docs(spark, d), "doc_id", "text").select("doc_id", *[s[k].alias(k) for k in names])
    return told.withColumn("label", C.classify_register({k: F.col(k) for k in names}))


@query(f"with s as (select doc_id, coalesce({_markers('text', C.MSA_MARKERS + C.FORMAL_EXTRA)}, 0) as formal_markers, coalesce({_hits('text', C.COLLOQUIAL_WORDS)}, 0) as colloquial_markers from documents) select *, greatest(0, colloquial_markers - formal_markers) as penalty from s")
def formal_quality(spark, d):
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", *[c.alias(k) for k, c in C.formal_quality(F.col("text")).items()])


_TASK_SQL = " ".join(f"when regexp_matches(prompt, '(?i){p}') then '{n}'" for n, p in C.TASK_PATTERNS)


@query(f"select item_id, case {_TASK_SQL} else 'other' end as label from eval_prompts")
def classify_task(spark, d):
    return table(spark, d, "eval_prompts").select("item_id", C.classify_task(F.col("prompt")).alias("label"))


def _tag_sql(x: str, r, k) -> str:
    return f"case when coalesce({_markers(f'lower({x})', r)}, 0) > 0 then 'reasoning' when coalesce({_markers(f'lower({x})', k)}, 0) > 0 then 'knowledge_qa' else 'general_instruction' end"


@query(f"select line_no, {_tag_sql(_LAST_USER, C.REASONING_HINTS, C.KNOWLEDGE_HINTS)} as long_label, {_tag_sql(_LAST_USER, C.REASONING_HINTS_SHORT, C.KNOWLEDGE_HINTS_SHORT)} as short_label from arabic_derja")
def tag_record(spark, d):
    u = M.last_of(F.col("messages"), "user")
    return dear(derja(spark, d), "line_no", "messages").select("line_no", C.tag_record(u).alias("long_label"), C.tag_record_short(u).alias("short_label"))


@query(f"select doc_id, coalesce({_markers('lower(text)', C.TRANSLATION_HINTS)} > 0, false) as translation from documents")
def is_translation(spark, d):
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", C.is_translation(F.col("text")).alias("translation"))


_TEXTS = "lower(coalesce(array_to_string(list_transform(messages, lambda m: m.content), ' '), ''))"


@query(f"select line_no, {_markers(_TEXTS, C.FR_SWITCH_MARKERS)} > 0 and {_markers(_TEXTS, C.AR_SWITCH_MARKERS)} > 0 as switching from arabic_derja")
def code_switching(spark, d):
    return dear(derja(spark, d), "line_no", "messages").select("line_no", C.code_switching(M.contents(F.col("messages"))).alias("switching"))


# --- validation ----------------------------------------------------------------------------------
_S = Schema()
_ROLES = "list_transform(messages, lambda m: m.role)"
_BODY = f"list_filter({_ROLES}, lambda r: r is null or r <> 'system')"
_VALID_SQL = f"""
with t as (select *, {_ROLES} as roles, {_BODY} as body, coalesce(array_to_string(list_transform(messages, lambda m: m.content), ' '), '') as alltext from arabic_derja),
e as (
 select line_no, 'invalid_type' as code, (case when id is null then 1 else 0 end + case when messages is null then 1 else 0 end + case when category is null then 1 else 0 end + case when language is null then 1 else 0 end + case when source is null then 1 else 0 end + coalesce(len(list_filter(messages, lambda m: m.content is null)), 0)) as n from t
 union all select line_no, 'empty_id', (case when id is not null and {_strip('id')} = '' then 1 else 0 end) from t
 union all select line_no, 'invalid_id', (case when id is not null and {_strip('id')} <> '' and not regexp_matches(id, '^[A-Za-z0-9._:-]+$') then 1 else 0 end) from t
 union all select line_no, 'invalid_category', (case when category not in ({_list(_S.categories)}) then 1 else 0 end) from t
 union all select line_no, 'invalid_language', (case when language not in ({_list(_S.languages)}) then 1 else 0 end) from t
 union all select line_no, 'invalid_script', (case when script not in ({_list(_S.scripts)}) then 1 else 0 end) from t
 union all select line_no, 'invalid_difficulty', (case when difficulty not in ({_list(_S.difficulties)}) then 1 else 0 end) from t
 union all select line_no, 'empty_source', (case when source is not null and {_strip('source')} = '' then 1 else 0 end) from t
 union all select line_no, 'language_script_mismatch', (case when messages is not null and language = 'ar' and script <> 'arabic' then 1 else 0 end + case when messages is not null and language = 'arabizi' and script <> 'latin' then 1 else 0 end) from t
 union all select line_no, 'script_content_mismatch', (case when messages is not null and script = 'arabic' and not regexp_matches(alltext, '[{_ARABIC}]') then 1 else 0 end + case when messages is not null and script = 'latin' and regexp_matches(alltext, '[{_ARABIC}]') and not regexp_matches(alltext, '[A-Za-z]') then 1 else 0 end) from t
 union all select line_no, 'empty_messages', (case when len(messages) = 0 or (len(messages) > 0 and len(body) = 0) then 1 else 0 end) from t
 union all select line_no, 'too_few_turns', (case when len(messages) > 0 and len(messages) < 2 then 1 else 0 end) from t
 union all select line_no, 'invalid_role', coalesce(len(list_filter(roles, lambda r: r is null or r not in ('system', 'user', 'assistant'))), 0) from t
 union all select line_no, 'empty_content', coalesce(len(list_filter(messages, lambda m: m.content is not null and {_strip('m.content')} = '')), 0) from t
 union all select line_no, 'invalid_ordering', (case when len(list_filter(roles, lambda r: r = 'system')) > 1 then 1 else 0 end + case when coalesce(list_position(roles, 'system'), 0) > 1 then 1 else 0 end + case when len(body) > 0 and coalesce(body[1], '') <> 'user' then 1 else 0 end + case when len(list_filter(range(2, len(body) + 1), lambda i: coalesce(body[i] = body[i - 1], false))) > 0 then 1 else 0 end + case when len(body) > 0 and coalesce(body[-1], '') <> 'assistant' then 1 else 0 end) from t)
"""


@query(_VALID_SQL + "select line_no, code, sum(n)::bigint as n from e group by all having sum(n) > 0")
def validate_records(spark, d):
    e = validate.error_rows(validate.validate_table(derja(spark, d), "line_no"))
    return e.groupBy(F.col("line").alias("line_no"), "code").agg(F.count(F.lit(1)).alias("n"))


@query(_VALID_SQL + "select code, sum(n)::bigint as n from e group by code having sum(n) > 0")
def error_code_counts(spark, d):
    return validate.code_counts(validate.error_rows(validate.validate_table(derja(spark, d), "line_no")))


@query(_VALID_SQL + ", bad as (select distinct line_no from e where n > 0), twice as (select id from arabic_derja where id is not null group by id having count(*) > 1) select line_no from arabic_derja where line_no not in (select line_no from bad) and (id is null or id not in (select id from twice))")
def valid_records(spark, d):
    r = derja(spark, d)
    return validate.valid_rows(r, validate.validate_table(r, "line_no"), "line_no").select("line_no")


@query(f"with f as (select id, min(line_no) as first, count(*) as n from arabic_derja where {_strip('id')} <> '' group by id having count(*) > 1) select a.line_no as line, a.id as record_id, 'duplicate_id' as code, 'first on line ' || first as message, 'id' as field from arabic_derja a join f using (id) where a.line_no > first")
def duplicate_ids(spark, d):
    return validate.duplicate_ids(derja(spark, d))


@query("select reject_reason, count(*) as n from (select case when quality.flagged then 'quality_flagged' when not coalesce(language in ('ar', 'arabizi'), false) then 'language_not_allowed' when not coalesce(script in ('arabic', 'latin'), false) then 'script_not_allowed' end as reject_reason from arabic_derja) group by 1")
def slice_gate(spark, d):
    rules = [("quality_flagged", F.col("quality")["flagged"]), ("language_not_allowed", ~F.coalesce(F.col("language").isin("ar", "arabizi"), F.lit(False))), ("script_not_allowed", ~F.coalesce(F.col("script").isin("arabic", "latin"), F.lit(False)))]
    return validate.gate(derja(spark, d), rules).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


# --- deduplication -------------------------------------------------------------------------------
@query("select line_no from arabic_derja where coalesce(id, '') = '' union all select min(line_no) as line_no from arabic_derja where coalesce(id, '') <> '' group by id")
def dedupe_by_id(spark, d):
    return dedup.by_id(derja(spark, d).select("line_no", "id")).select("line_no")


@query(f"with x as (select min(doc_id) as doc_id from documents group by text), y as (select min(doc_id) as doc_id from documents semi join x using (doc_id) group by {_NORM}) select doc_id from y")
def exact_norm_dedup(spark, d):
    return dedup.exact_then_normalised(docs(spark, d).select("doc_id", "text"), "text", "doc_id")[0].select("doc_id")


@query(f"with x as (select min(doc_id) as doc_id from documents group by text), y as (select min(doc_id) as doc_id from documents semi join x using (doc_id) group by {_NORM}) select (select count(*) from documents) - (select count(*) from x) as exact_removed, (select count(*) from x) - (select count(*) from y) as normalised_removed, (select count(*) from y) as kept")
def dedup_counts(spark, d):
    return dedup.exact_then_normalised(docs(spark, d).select("doc_id", "text"), "text", "doc_id")[1]


@query(
    r"with recursive t as (select doc_id, text, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents where coalesce(text, '') <> ''), "
    "r as (select text, min(doc_id) as rep, any_value(w) as w from t group by text), "
    "s as (select distinct rep, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from r), "
    "n as (select rep, count(*) as n from s group by rep), p as (select x.rep as a, y.rep as b, count(*) as c from s x join s y on x.g = y.g and x.rep <> y.rep group by all), "
    "l as (select a, b from p join n x on x.rep = a join n y on y.rep = b where c::double / (x.n + y.n - c) >= 0.8::double), "
    "c as (select rep as id, rep as reach from r union select c.id, l.b from c join l on l.a = c.reach), k as (select id, min(reach) as class_id from c group by id) "
    "select doc_id, class_id from t join r using (text) join k on k.id = r.rep union all select doc_id, doc_id from documents where coalesce(text, '') = ''"
)
def near_dup_classes(spark, d):
    """Class of every document at a similarity of 0.8 on runs of five words."""
    return dedup.near_duplicates(docs(spark, d), "doc_id", "text")


# --- sampling ------------------------------------------------------------------------------------
@query(f"select doc_id from documents order by {_KEY.format('doc_id')}, doc_id limit 100")
def stable_sample_topk(spark, d):
    return sampling.top_k(docs(spark, d).select("doc_id"), 100, ident="doc_id")


@query(f"select doc_id, case when row_number() over (order by {_KEY.format('doc_id')}, doc_id) <= 150 then 'holdout' else 'train' end as part from documents")
def split_exact(spark, d):
    return sampling.split_exact(docs(spark, d).select("doc_id"), 150, ident="doc_id")


_LR = "with w as (select coalesce({c}, '{miss}') as s, count(*) as n from {t} group by 1), x as (select s, {k} * n::double / sum(n::double) over () as x from w), f as (select s, floor(x) as base, x - floor(x) as frac from x), r as (select s, base, {k} - sum(base) over () as rest, row_number() over (order by frac desc, s desc) as r from f), q as (select s, (base + case when r <= rest then 1 else 0 end)::bigint as quota from r)"


@query(_LR.format(c="source", miss="None", t="documents", k=137) + " select s as source, quota from q")
def largest_remainder_quota(spark, d):
    w = docs(spark, d).groupBy(F.coalesce("source", F.lit("None")).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return sampling.largest_remainder(w, "source", "n", 137)


@query(_LR.format(c="lang", miss="__unknown__", t="documents", k=200) + f", p as (select doc_id, coalesce(lang, '__unknown__') as s, row_number() over (partition by coalesce(lang, '__unknown__') order by {_KEY.format('doc_id')}, doc_id) as r from documents) select doc_id, case when r <= quota then 'holdout' else 'train' end as part from p join q using (s)")
def stratified_split(spark, d):
    return sampling.stratified_split(docs(spark, d).select("doc_id", "lang"), 200, "lang", ident="doc_id").select("doc_id", "part")


@query(_LR.format(c="source", miss="__no_group__", t="documents", k=120) + f", p as (select doc_id, coalesce(source, '__no_group__') as s, row_number() over (partition by coalesce(source, '__no_group__') order by {_KEY.format('doc_id')}, doc_id) as r from documents) select doc_id, case when r <= quota then 'holdout' else 'train' end as part from p join q using (s)")
def group_stratified_split(spark, d):
    return sampling.group_stratified_split(docs(spark, d).select("doc_id", "source"), 120, "source", ident="doc_id").select("doc_id", "part")


@query(f"with g as (select coalesce(source, '__no_group__') as g, count(*) as n from documents group by 1), u as (select g, sum(n) over (order by {_KEY.format('g')}) as upto from g) select doc_id, case when upto <= 300 then 'holdout' else 'train' end as part from documents join u on u.g = coalesce(source, '__no_group__')")
def group_holdout(spark, d):
    return sampling.group_holdout(docs(spark, d).select("doc_id", "source"), 300, "source").select("doc_id", "part")


@query(f"with p as (select doc_id, row_number() over (partition by coalesce(source, '__unknown__') order by {_KEY.format('doc_id')}, doc_id) as r, count(*) over (partition by coalesce(source, '__unknown__')) as n from documents) select doc_id, case when r <= greatest(1, floor(n * 0.05::double)) then 'holdout' else 'train' end as part from p")
def ratio_split(spark, d):
    return sampling.ratio_split(docs(spark, d).select("doc_id", "source"), 0.05, "source", ident="doc_id").select("doc_id", "part")


@query(f"with p as (select doc_id, row_number() over (partition by coalesce(lang, '__unknown__') order by {_KEY.format('doc_id')}, doc_id) as r, count(*) over (partition by coalesce(lang, '__unknown__')) as n from documents) select doc_id, case when r <= round_even(n * 0.05::double, 0) then 'val' when r <= 2 * round_even(n * 0.05::double, 0) then 'test' else 'train' end as part from p")
def split_90_5_5(spark, d):
    return sampling.three_way_split(docs(spark, d).select("doc_id", "lang"), "lang", ident="doc_id").select("doc_id", "part")


@query(f"with p as (select doc_id, {_KEY.format('doc_id')} as k, row_number() over (partition by coalesce(source, '') order by {_KEY.format('doc_id')}, doc_id) as r from documents) select doc_id from p order by r > 20, k, doc_id limit 400")
def source_diverse_pick(spark, d):
    return sampling.source_diverse(docs(spark, d).select("doc_id", "source"), 400, 0.05, ident="doc_id").select("doc_id")


@query("with w as (select coalesce(category, 'None') as category, count(*) as n from documents group by 1), b as (select category, floor(500 * n / sum(n) over ())::bigint as b from w) select category, case when row_number() over (order by category desc) = 1 then 500 - sum(b) over () + b else b end::bigint as quota from b")
def proportional_floor_last(spark, d):
    w = docs(spark, d).groupBy(F.coalesce("category", F.lit("None")).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return sampling.proportional_last(w, "category", "n", 500)


@query(f"select line_no from (select line_no, row_number() over (partition by substr(sha256({_SYSTEM}), 1, 16) order by line_no) as r from arabic_derja) where r <= 200")
def cap_per_template(spark, d):
    return sampling.cap_per(derja(spark, d).select("line_no", "messages"), M.template_key(F.col("messages")), 200, ["line_no"]).select("line_no")


@query(f"select line_no from (select line_no, row_number() over (partition by case when {_LAST_USER} = '' then 'row:' || line_no else sha256({_LAST_USER}) end order by line_no) as r from arabic_derja) where r <= 2")
def cap_per_passage(spark, d):
    return sampling.cap_passages(derja(spark, d).select("line_no", "messages"), M.last_of(F.col("messages"), "user"), 2, ["line_no"], "line_no").select("line_no")


@query("with one as (select * from arabic_derja where language = 'ar'), k as (select floor(0.25::double * count(*) + 0.5)::bigint as k from one), w as (select coalesce(category, '__unknown__') as s, count(*) as n from one group by 1), x as (select s, k * n::double / sum(n::double) over () as x, k from w, k), f as (select s, k, floor(x) as base, x - floor(x) as frac from x), r as (select s, base, k - sum(base) over () as rest, row_number() over (order by frac desc, s desc) as r from f), q as (select s, base + case when r <= rest then 1 else 0 end as quota from r), p as (select line_no, coalesce(category, '__unknown__') as s, row_number() over (partition by coalesce(category, '__unknown__') order by sha256('42:' || line_no::varchar), line_no) as r from one) select line_no from p join q using (s) where p.r <= quota union all select line_no from arabic_derja where language is null or language <> 'ar'")
def downsample_class_25pct(spark, d):
    return sampling.downsample_class(derja(spark, d).select("line_no", "language", "category"), "language", "ar", 0.25, ident="line_no").select("line_no")


@query(f"with t as (select line_no, category, {_tag_sql(_LAST_USER, C.REASONING_HINTS, C.KNOWLEDGE_HINTS)} as tag, row_number() over (partition by category order by {_KEY.format('line_no')}, line_no) as r from arabic_derja) select category, count(*) as sampled, count_if(tag = category) as agreeing, count_if(tag = category) / count(*) as accuracy from t where r <= 200 group by category")
def audit_sample_accuracy(spark, d):
    tagged = derja(spark, d).withColumn("tag", C.tag_record(M.last_of(F.col("messages"), "user"))).select("line_no", "category", "tag")
    return sampling.audit_sample(tagged, "category", F.col("tag"), ident="line_no")


# --- budgets -------------------------------------------------------------------------------------
def _pool(spark, d):
    return profile.token_columns(derja(spark, d).select("line_no", "id", "messages", "category", "source", "language", "quality"))


@query(f"with recursive p as (select line_no, category, {_TOTAL}::double as v, row_number() over (partition by category order by {_KEY.format('line_no')}) as rn from arabic_derja where category is not null and {_TOTAL} > 0), t as (select category, sum(v) * 0.25::double * 0.98::double as lower, sum(v) * 0.25::double * 1.02::double as upper from p group by 1), s as (select category, 0::bigint as rn, 0::double as total, false as taken from t union all select s.category, p.rn, case when s.total + p.v <= t.upper then s.total + p.v else s.total end, s.total + p.v <= t.upper from s join t using (category) join p on p.category = s.category and p.rn = s.rn + 1 where s.total < t.lower) select p.line_no, p.category, p.v::bigint as tokens_total from s join p using (category, rn) where s.taken")
def greedy_budget_fill(spark, d):
    """A quarter of each category's tokens, two per cent either way."""
    pool = _pool(spark, d).where("category is not null").select("line_no", "category", "tokens_total")
    targets = pool.groupBy("category").agg((F.sum("tokens_total") * 0.25).alias("target"))
    return budget.greedy_fill(pool, targets, "category", "tokens_total", 0.02, ident="line_no").select("line_no", "category", "tokens_total")


def _fold(source: str, stop: str, room: str, group: str = "g") -> str:
    """Rows of ``source`` (g, id, k, v) that a visit in order of k takes while the total is below ``stop`` and stays within ``room``: g, id."""
    item = "{{'acc': {0}, 'took': {1}, 'id': {2}, 'v': {3}, 'stop': {4}, 'room': {5}}}"
    first = item.format("0::double", "[]::bigint[]", "0::bigint", "0::double", "0::double", "0::double")
    each = item.format("0::double", "[]::bigint[]", "id::bigint", "v::double", f"({stop})::double", f"({room})::double")
    step = "case when a.acc < x.stop and a.acc + x.v <= x.room then " + item.format("a.acc + x.v", "list_append(a.took, x.id)", "x.id", "x.v", "x.stop", "x.room") + " else " + item.format("a.acc", "a.took", "x.id", "x.v", "x.stop", "x.room") + " end"
    return f"select {group}, unnest(list_reduce(list({each} order by k, id), lambda a, x: {step}, {first}).took) as id from {source} group by {group}"


def _level(n: int, fraction: float) -> str:
    """One level of the nested variants: what it leaves (l) becomes the next level's pool; t are the rows taken, z the tokens spent."""
    return (
        f"b{n} as (select floor((select sum(v) from p) * {fraction}::double) as budget, (select spent from z{n - 1}) as spent), "
        f"h{n} as (select k, id, v from l{n - 1}, b{n} where v <= budget order by k, id limit 1), "
        f"o{n} as (select 0 as g, l.id, l.k, l.v, h.v as had, greatest(b.budget - b.spent, 0) as room from l{n - 1} l, h{n} h, b{n} b where l.k > h.k), "
        f"t{n} as (select id from h{n} union all select id from ({_fold(f'o{n}', '1e300', 'room - had')})), "
        f"l{n} as (select * from l{n - 1} where id not in (select id from t{n})), z{n} as (select (select spent from z{n - 1}) + coalesce((select sum(v) from l{n - 1} where id in (select id from t{n})), 0) as spent)"
    )


@query(
    f"with p as (select line_no as id, language, {_TOTAL} as v, {_KEY.format('line_no')} as k from arabic_derja), l0 as (select * from p where language in ('ar', 'en')), z0 as (select coalesce(sum(v), 0) as spent from p where language in ('arabizi', 'mixed')), {_level(1, 0.25)}, {_level(2, 0.5)}, {_level(3, 0.75)} "
    "select id as line_no, 'v25' as variant from p where language in ('arabizi', 'mixed') union all select id, 'v25' from t1 union all select id, 'v50' from t2 union all select id, 'v75' from t3"
)
def nested_variants(spark, d):
    """The smallest of three nested variants that holds each record."""
    pool = _pool(spark, d).select("line_no", "language", F.col("tokens_total").alias("tokens"))
    return budget.nested_variants(pool, {"v25": 0.25, "v50": 0.5, "v75": 0.75}, ["arabizi", "mixed"], ["ar", "en"], ident="line_no")


#: Records that may be selected, the first of each identifier, with their tokens.
_UNIQUE = "u as (select a.line_no, a.id, a.category, a.source, {total} as total, {assist}::double as v, sha256('42:' || a.id) as k from arabic_derja a join (select id, min(line_no) as line_no from arabic_derja where not coalesce(quality.flagged, false) and language in ({langs}) and category in ({cats}) group by id) f on f.id = a.id and f.line_no = a.line_no)"


def _greedy(name: str, pool: str, targets: str) -> str:
    """The greedy fill of categories around targets (category, target), two per cent either way."""
    rows = f"(select u.category as g, u.line_no as id, u.k, u.v, t.target * 0.98::double as low, t.target * 1.02::double as high from {pool} u join {targets} t on t.category = u.category where u.v > 0 and t.target > 0)"
    return f"{name} as (select u.* from u join ({_fold(rows, 'low', 'high')}) f on f.id = u.line_no)"


def _weights(values: dict[str, float]) -> str:
    return "(values " + ", ".join(f"('{k}', {v}::double)" for k, v in values.items()) + ") w(category, w)"


_CATS = "'coding', 'mathematics', 'reasoning', 'general_instruction', 'knowledge_qa'"
_BOTH = "select line_no, category, 'train' as part from tr union all select line_no, category, 'holdout' from ho"


@query(
    f"with {_UNIQUE.format(total=_TOTAL, assist=_ASSIST, langs=_list(['ar', 'arabizi', 'fr', 'en']), cats=_CATS)}, fit as (select * from u where total <= 15500), anchor as (select * from fit where category = 'coding' order by k, id limit 50), unit as (select sum(v) as unit from anchor), rest as (select * from fit where line_no not in (select line_no from anchor)), "
    f"ht as (select category, 0.05::double * unit * w as target from unit, {_weights({'coding': 0.25, 'mathematics': 0.25, 'reasoning': 0.2, 'general_instruction': 0.15, 'knowledge_qa': 0.15})}), {_greedy('ho', 'rest', 'ht')}, left_ as (select * from rest where line_no not in (select line_no from ho)), "
    f"tt as (select category, unit * w as target from unit, {_weights({'mathematics': 1.0, 'reasoning': 0.8, 'general_instruction': 0.6, 'knowledge_qa': 0.6})}), {_greedy('filled', 'left_', 'tt')}, tr as (select * from anchor union all select * from filled) {_BOTH}"
)
def token_budget_selection(spark, d):
    """Anchor, holdout and train around it."""
    spec = RetentionSpec(languages=("ar", "arabizi", "fr", "en"), anchor="coding", anchor_examples=50, multipliers={"coding": 1.0, "mathematics": 1.0, "reasoning": 0.8, "general_instruction": 0.6, "knowledge_qa": 0.6}, holdout_shares={"coding": 0.25, "mathematics": 0.25, "reasoning": 0.2, "general_instruction": 0.15, "knowledge_qa": 0.15}, on_insufficient="fill")
    s = budget.select_by_tokens(derja(spark, d), spec)
    return s.train.select("line_no", "category", F.lit("train").alias("part")).unionByName(s.holdout.select("line_no", "category", F.lit("holdout").alias("part")))


@query(
    f"with {_UNIQUE.format(total=_TOTAL, assist=_ASSIST, langs=_list(['ar', 'arabizi', 'fr', 'en']), cats=_CATS)}, w as (select category as s, count(*) as n from u group by 1), x as (select s, 25 * n::double / sum(n::double) over () as x from w), f as (select s, floor(x) as base, x - floor(x) as frac from x), r as (select s, base, 25 - sum(base) over () as rest, row_number() over (order by frac desc, s desc) as r from f), q as (select s, base + case when r <= rest then 1 else 0 end as quota from r), "
    "placed as (select u.*, row_number() over (partition by category order by k, id) as place from u), ho as (select p.* from placed p join q on q.s = p.category where place <= quota), pool as (select * from u where line_no not in (select line_no from ho)), "
    f"want as (select category, w::int as n, greatest(1, floor(w * 0.3::double))::int as cap from {_weights({'coding': 50, 'mathematics': 50, 'reasoning': 40, 'general_instruction': 30, 'knowledge_qa': 30})}), capped as (select p.*, n, cap, row_number() over (partition by category, coalesce(source, '') order by k, id) > cap as over from pool p join want using (category)), "
    f"tr as (select * from (select *, row_number() over (partition by category order by over, k, id) as place from capped) where place <= n) {_BOTH}"
)
def count_selection(spark, d):
    """Counts by category after a stratified holdout."""
    spec = RetentionSpec(targets={"coding": 50, "mathematics": 50, "reasoning": 40, "instruction_following": 30, "knowledge_qa": 30}, holdout_size=25, languages=("ar", "arabizi", "fr", "en"), max_share_per_source=0.3, on_insufficient="fill")
    s = budget.select_by_count(derja(spark, d), spec)
    return s.train.select("line_no", "category", F.lit("train").alias("part")).unionByName(s.holdout.select("line_no", "category", F.lit("holdout").alias("part")))


@query(f"with p as (select line_no, category, {_TOTAL}::bigint as tokens_total, coalesce(sum({_TOTAL}) over (partition by category order by {_KEY.format('line_no')}, line_no rows between unbounded preceding and 1 preceding), 0) as before, floor(sum({_TOTAL}) over (partition by category) * 0.1::double) as quota from arabic_derja where category is not null) select line_no, category, tokens_total from p where before + tokens_total <= quota or before = 0")
def prefix_sample(spark, d):
    """Records of each category up to the first that exceeds a tenth of its tokens."""
    pool = _pool(spark, d).where("category is not null").select("line_no", "category", "tokens_total")
    q = pool.groupBy("category").agg(F.floor(F.sum("tokens_total") * 0.1).alias("quota"))
    return budget.prefix_sample(pool, "category", "tokens_total", q, ident="line_no")


_BIN = "{{'room': {0}, 'bins': {1}, 'v': {2}, 'at': {3}}}"
_AT = "coalesce(list_position(list_transform(a.room, lambda r: r >= x.v), true), len(a.room) + 1)"


def _packed() -> str:
    at = f"(case when x.v > 16384 then 0 else {_AT} end)"
    room = f"case when {at} = 0 then a.room when {at} > len(a.room) then list_append(a.room, 16384 - x.v) else list_transform(a.room, lambda r, i: case when i = {at} then r - x.v else r end) end"
    step = _BIN.format(room, f"list_append(a.bins, {at} - 1)", "x.v", "0::bigint")
    first, each = _BIN.format("[]::bigint[]", "[]::bigint[]", "0::bigint", "0::bigint"), _BIN.format("[]::bigint[]", "[]::bigint[]", "v", "0::bigint")
    return (
        f"with p as (select line_no, coalesce(category, 'None') as category, {_TOTAL}::bigint as v from arabic_derja), f as (select category, list(line_no order by v desc, line_no) as ids, list(v order by v desc, line_no) as vs, list_reduce(list({each} order by v desc, line_no), lambda a, x: {step}, {first}).bins as bins from p group by category) "
        "select category, 0 as shard, unnest(ids) as line_no, unnest(bins) as bin, unnest(vs) as tokens_total from f"
    )


@query(_packed())
def packed_bins(spark, d):
    """First-fit-decreasing bins of 16,384 tokens in each category."""
    pool = _pool(spark, d).select("line_no", "tokens_total", F.coalesce("category", F.lit("None")).alias("category"))
    return budget.pack_first_fit(pool, "category", "tokens_total", 16_384, "line_no")


# --- leakage and mixtures ------------------------------------------------------------------------
@query("with a as (select distinct id from arabic_derja where split = 'train' and id is not null), b as (select distinct id from arabic_derja where split in ('val', 'test')), l as (select id from a semi join b using (id)) select (select count(*) from l) as leaked, coalesce((select array_to_string(list_sort(list(id)), ',') from (select id from l order by id limit 5)), '') as examples")
def leakage_semi(spark, d):
    r = derja(spark, d)
    return mixture.leak_summary(r.where("split = 'train'"), r.where("split in ('val', 'test')"))


@query("select line_no from arabic_derja where id is null or id not in (select id from raw_dialect_qa where id is not null)")
def anti_existing(spark, d):
    return mixture.without(derja(spark, d).select("line_no", "id"), table(spark, d, "raw_dialect_qa").where("id is not null"), "id").select("line_no")


@query(f"select distinct {_LAST_USER} as text from arabic_derja where category = 'knowledge_qa' and {_LAST_USER} <> '' intersect select {_LAST_USER} from arabic_derja where category = 'general_instruction'")
def cross_category_overlap(spark, d):
    return budget.cross_contamination(derja(spark, d), "knowledge_qa", "general_instruction")


@query("with s as (select distinct id as k, split as s from arabic_derja where id is not null and split is not null) select a.s as split_a, b.s as split_b, count(*) as shared from s a join s b on a.k = b.k and a.s < b.s group by all")
def cross_split_overlap(spark, d):
    return mixture.pairwise_overlap(derja(spark, d).where("id is not null"), "split", F.col("id"))


_MIX = MixtureSpec({"ar": 0.5, "arabizi": 0.2, "fr": 0.15, "en": 0.15})


@query(f"with n as (select language as slice, count(*) as n from arabic_derja group by 1), dd as (select unnest([{_list(_MIX.shares)}]) as slice) select n.slice, 'undeclared_slice' as violation, n::varchar as detail from n where n.slice is null or n.slice not in (select slice from dd) union all select slice, 'empty_slice', 'no examples' from dd where slice not in (select slice from n where slice is not null) union all select x.slice, 'holdout_leak', count(*)::varchar from (select language as slice from arabic_derja where id in (select id from arabic_derja where split = 'test')) x group by x.slice")
def mixture_validation(spark, d):
    r = derja(spark, d)
    return mixture.mixture_violations(r, _MIX, "language", holdout=r.where("split = 'test'"))


_QUARTER = "one as (select * from arabic_derja where language = 'ar' and split = 'train'), k as (select floor(0.25::double * count(*) + 0.5)::bigint as k from one), w as (select coalesce(category, '__unknown__') as s, count(*) as n from one group by 1), x as (select s, k * n::double / sum(n::double) over () as x, k from w, k), f as (select s, k, floor(x) as base, x - floor(x) as frac from x), r as (select s, base, k - sum(base) over () as rest, row_number() over (order by frac desc, s desc) as r from f), q as (select s, base + case when r <= rest then 1 else 0 end as quota from r), p as (select line_no, coalesce(category, '__unknown__') as s, row_number() over (partition by coalesce(category, '__unknown__') order by sha256('42:' || line_no::varchar), line_no) as r from one), source as (select line_no, language, split from arabic_derja where split = 'train'), derived as (select line_no, language, split from source where language is null or language <> 'ar' or line_no in (select line_no from p join q using (s) where p.r <= quota))"


@query(
    f"with {_QUARTER}, n as (select (select count(*) from derived where line_no not in (select line_no from source)) as stray, (select count(*) from (select line_no from derived group by 1 having count(*) > 1)) as twice, (select count(*) from derived where line_no in (select line_no from arabic_derja where split = 'test')) as leak, (select count(*) from derived where language = 'ar') / (select count(*) from source where language = 'ar') as ratio, "
    "(select count(*) from derived where language in ('arabizi', 'mixed', 'fr', 'en')) = (select count(*) from source where language in ('arabizi', 'mixed', 'fr', 'en')) as kept) "
    "select 'subset_of_source' as check, stray = 0 as ok, stray::varchar as detail from n union all select 'no_repeated_key', twice = 0, twice::varchar from n union all select 'classes_preserved', kept, 'arabizi,mixed,fr,en' from n union all select 'sampled_fraction', abs(ratio - 0.25) <= 0.005, format('{:.4f}', ratio) from n union all select 'no_leak', leak = 0, leak::varchar from n "
    "union all select 'content_unchanged', true, '0' union all select 'rows_expected', true, (select count(*)::varchar from derived)"
)
def integrity_report(spark, d):
    """Checks of the quarter-sampled train split against its source and the test split."""
    whole = derja(spark, d).select("line_no", "language", "category", "messages", "split")
    r = whole.where("split = 'train'")
    derived = sampling.downsample_class(r, "language", "ar", 0.25, ident="line_no")
    n = r.agg(F.count_if(~(F.col("language") == "ar") | F.col("language").isNull()).alias("others"), F.floor(F.count_if(F.col("language") == "ar") * 0.25 + 0.5).alias("some"))
    return integrity.integrity_report(derived, r, ["arabizi", "mixed", "fr", "en"], "ar", 0.25, holdout=whole.where("split = 'test'"), content=F.col("messages"), expected=n.select((F.col("others") + F.col("some")).cast("long").alias("rows")))


_W = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


@query(f"with dw as (select doc_id, {_W.format('text')} as w from documents), ds as (select distinct doc_id, unnest(case when len(w) >= 8 then list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from dw), iw as (select item_id, {_W.format('prompt')} as w from eval_prompts), js as (select distinct item_id, unnest(case when len(w) >= 8 then list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from iw) select doc_id, item_id, count(*) as shared from ds join js using (s) group by all")
def contamination_ngrams(spark, d):
    return mixture.shared_shingles(docs(spark, d), table(spark, d, "eval_prompts"), "doc_id", "text", "item_id", "prompt", 8)


# --- exports and adapters ------------------------------------------------------------------------
_OUT = "case m.role when 'user' then 'human' when 'assistant' then 'gpt' when 'system' then 'system' end"


@query(f"select line_no, md5(array_to_string(list_transform(messages, lambda m: coalesce({_OUT}, '') || ':' || coalesce(m.content, '')), chr(10))) as body, len(messages) as turns from arabic_derja where messages is not null")
def export_sharegpt(spark, d):
    rows = derja(spark, d).where("messages is not null").select("line_no", M.to_sharegpt(F.col("messages")).alias("c"))
    text = F.array_join(F.transform("c", lambda m: F.concat(F.coalesce(m["from"], F.lit("")), F.lit(":"), F.coalesce(m["value"], F.lit("")))), "\n")
    return rows.select("line_no", F.md5(text).alias("body"), F.size("c").alias("turns"))


@query(f"select line_no, {_LAST_USER} as user_text, {_SYSTEM} as system_text from arabic_derja")
def last_user_turn(spark, d):
    m = F.col("messages")
    return derja(spark, d).select("line_no", M.last_of(m, "user").alias("user_text"), M.first_of(m, "system").alias("system_text"))


_PARTS = f"list_filter(list_transform(string_split(replace(replace({_strip('text')}, '।', '.'), '؟', '?'), '. '), lambda p: {_strip('p')}), lambda p: p <> '')"


@query(f"with p as (select doc_id, {_strip('text')} as t, {_PARTS} as parts from documents where {_strip('text')} <> ''), q as (select doc_id, case when len(parts) = 0 then [t] else parts end as parts from p) select doc_id, (len(parts) + len(parts) % 2)::int as turns, md5(array_to_string(case when len(parts) % 2 = 1 then list_append(parts, 'فهمت.') else parts end, chr(10))) as body from q")
def messages_from_text(spark, d):
    rows = docs(spark, d).select("doc_id", M.from_text(F.col("text")).alias("m")).where("m is not null")
    return rows.select("doc_id", F.size("m").alias("turns"), F.md5(M.contents(F.col("m"), "\n")).alias("body"))


@query("select coalesce(instruction, '') as instruction, coalesce(input, '') as input, coalesce(output, '') as output from raw_dialect_qa")
def alpaca_projection(spark, d):
    return writers.alpaca(table(spark, d, "raw_dialect_qa"), {"instruction": "instruction", "input": "input", "output": "output"})


@query(f"select skip_reason, count(*) as n from (select case when {_strip(_or_empty('instruction'))} = '' and {_strip(_or_empty('input'))} = '' then 'empty_prompt' when {_strip(_or_empty('output'))} = '' then 'empty_output' end as skip_reason from raw_dialect_qa) group by 1")
def adapter_skips(spark, d):
    return A.qa_or_reason(table(spark, d, "raw_dialect_qa")).groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n"))


@query("select language, count(*) as n from (select case lower(trim(dialect)) " + " ".join(f"when '{k}' then '{v}'" for k, v in A.DIALECT_LANGUAGE.items()) + f" else 'ar' end as language from raw_dialect_qa where {_collapse(_or_empty('instruction'))} <> '' or {_collapse(_or_empty('input'))} <> '' or {_collapse(_or_empty('output'))} <> '') group by 1")
def dialect_records(spark, d):
    return A.dialect_qa(table(spark, d, "raw_dialect_qa"), "qa").groupBy("language").agg(F.count(F.lit(1)).alias("n"))


@query("with t as (select line_no, unnest(messages) as m, generate_subscripts(messages, 1) - 1 as pos from arabic_derja), f as (select line_no, pos, pos - row_number() over (partition by line_no order by pos) as island from t where m.role = 'assistant') select line_no, min(pos)::int as start, max(pos)::int as stop, count(*) as length from f group by line_no, island")
def trained_spans(spark, d):
    return integrity.trained_spans(derja(spark, d).select("line_no", "messages"), "line_no")


_CREDENTIALS = {"hub_token": r"hf_[A-Za-z0-9]{20,}", "long_token": r"[A-Za-z0-9_]{16,}"}


@query(" union all ".join(f"select '{k}' as pattern, count_if(regexp_matches(coalesce(text, ''), '{p}')) as documents, coalesce(sum(len(regexp_extract_all(text, '{p}'))), 0)::bigint as hits from documents" for k, p in _CREDENTIALS.items()))
def secret_scan(spark, d):
    """Documents and hits of what looks like a credential, or like any long token."""
    out = None
    for name, pattern in _CREDENTIALS.items():
        part = integrity.secrets(docs(spark, d), "text", pattern).agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("hits"), F.lit(0)).cast("long").alias("hits")).select(F.lit(name).alias("pattern"), "documents", "hits")
        out = part if out is None else out.unionByName(part)
    return out


_OK = " and ".join(f"coalesce({_strip(c)} <> '', false)" for c in ("instruction", "output"))


@query(f"select count(*) as rows, count_if({_OK}) as valid from raw_dialect_qa")
def alpaca_format(spark, d):
    return formats.report(table(spark, d, "raw_dialect_qa"), "alpaca")


_BODY2 = f"(case when {_ROLES}[1] = 'system' then {_ROLES}[2:] else {_ROLES} end)"


@query(f"select count(*) as rows, count_if(coalesce(len(messages) >= 2 and {_BODY2}[1] = 'user' and {_BODY2}[-1] = 'assistant' and len(list_filter(messages, lambda m: not (coalesce(m.role in ('system', 'user', 'assistant'), false) and {_strip(_or_empty('m.content'))} <> ''))) = 0, false)) as valid from arabic_derja")
def chatml_format(spark, d):
    return formats.report(derja(spark, d), "chatml")


@query(f"with g as (select coalesce(language, 'None') as slice, sum({_ASSIST})::bigint as tokens from arabic_derja group by 1), t as (select unnest(['ar', 'arabizi', 'fr', 'en']) as slice, unnest([0.5, 0.2, 0.15, 0.15])::double as share), j as (select t.slice, share, coalesce(tokens, 0)::bigint as tokens from t left join g using (slice)) select slice, share, tokens, share * sum(tokens) over () - tokens as gap from j")
def token_gap(spark, d):
    """Tokens that each slice lacks to its share of what there is."""
    g = derja(spark, d).groupBy(F.coalesce("language", F.lit("None")).alias("slice")).agg(F.sum(M.tokens_assistant(F.col("messages"))).alias("tokens"))
    t = spark.createDataFrame(list(_MIX.shares.items()), "slice string, share double")
    j = t.join(g, "slice", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    total = j.agg(F.sum("tokens").alias("t"))
    return j.crossJoin(F.broadcast(total)).select("slice", "share", "tokens", (F.col("share") * F.col("t") - F.col("tokens")).alias("gap"))


_SLICE = {"knowledge_qa": 0.8, "general_instruction": 0.6, "reasoning": 0.2}


@query(
    f"with {_UNIQUE.format(total=_TOTAL, assist=_ASSIST, langs=_list(['ar', 'arabizi']), cats=_list(_SLICE))}, pool as (select * from u where total <= 15500), unit as (select sum(v) as unit from pool where category = 'knowledge_qa'), "
    f"ht as (select category, 0.05::double * unit * w / 1.6::double as target from unit, {_weights(_SLICE)}), {_greedy('ho', 'pool', 'ht')}, rest as (select * from pool where line_no not in (select line_no from ho)), tt as (select category, w * unit as target from unit, {_weights(_SLICE)}), {_greedy('tr', 'rest', 'tt')} {_BOTH}"
)
def slice_budget_selection(spark, d):
    """Budgets of the dialect slice around its whole question-answering category."""
    s = budget.select_slice(derja(spark, d), _SLICE, "knowledge_qa", ["ar", "arabizi"])
    return s.train.select("line_no", "category", F.lit("train").alias("part")).unionByName(s.holdout.select("line_no", "category", F.lit("holdout").alias("part")))


@query("with recursive v as (select vec_id, embedding from embeddings), l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.embedding::double[], b.embedding::double[]) >= 0.85), r as (select vec_id as id, vec_id as reach from v union select r.id, l.b from r join l on l.a = r.reach) select id as vec_id, min(reach) as class_id from r group by id")
def semantic_classes(spark, d):
    """Class of every embedding at a cosine of 0.85."""
    return dedup.semantic_duplicates(table(spark, d, "embeddings"), "vec_id", "embedding")


@query("select time_bucket(interval '1 hour', ts) as hour, event_type, count(*) as n, sum(value) as total from events group by all")
def events_hourly(spark, d):
    """Tumbling hours of the event stream, as the streaming operator gives them."""
    e = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return e.select(F.col("w.start").alias("hour"), "event_type", "n", "total")


@query("select time_bucket(interval '1 hour', ts) as hour, event_type, count(*) as n from events group by all")
def events_stream_hourly(spark, d):
    """The same counts by the streaming operator, run over the events that are there."""
    path = f"{d}/events.parquet"
    # a pattern may be a file or a folder
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{d}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
    out = ingest.run_to_table(ingest.windowed_counts(stream, "ts", ["event_type"]), "events")
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")


# --- audits --------------------------------------------------------------------------------------
def _register_sql(x: str) -> str:
    a, lat = _chars(x, _ARABIC), _chars(x, "A-Za-z")
    msa, dialect = f"({_markers(x, C.MSA_MARKERS)} + {_markers(x, C.MSA_QUESTION_WORDS)})", _hits(x, _DIALECT)
    return f"case when {lat} > {a} * 0.5 and {lat} > 10 then 'latin_or_code_switched' when {a} < 30 and {lat} < 10 then 'other' when {dialect} >= 2 and {dialect} > {msa} then 'dialect' when {msa} >= 1 and {dialect} <= 1 then 'msa' when {msa} >= 1 and {dialect} >= 2 then 'mixed' when {msa} = 0 and {dialect} = 0 then case when {a} >= 30 then 'msa' else 'other' end else 'mixed' end"


_PENALTY = f"least(5, greatest(0, {_hits('text', C.COLLOQUIAL_WORDS)} - {_markers('text', C.MSA_MARKERS + C.FORMAL_EXTRA)}))"


@query(
    f"with q as (select concat(coalesce(instruction, ''), ' ', coalesce(output, '')) as text, coalesce(instruction, '') as prompt, coalesce(output, '') as answer, dialect from raw_dialect_qa), t as (select {_register_sql('text')} as register, {_PENALTY}::varchar as penalty, case {_TASK_SQL} else 'other' end as task, "
    f"case when {_strip('prompt')} = '' or {_strip('answer')} = '' then 'empty_instruction_or_output' else 'none' end as malformed, coalesce(dialect, 'None') as source from q), "
    f"g as (select count(*) as n from q group by {_strip('prompt')}, {_strip('answer')}) "
    + " union all ".join(f"select '{c}' as facet, {c} as value, count(*) as n from t group by {c}" for c in ("register", "penalty", "task", "malformed", "source"))
    + " union all select 'duplicates', 'exact_pair', sum(n - 1)::bigint from g"
)
def pool_audit(spark, d):
    """Register, penalty, task, malformed rows, dialects and repeated pairs of the raw pool."""
    return audit.pool_audit(table(spark, d, "raw_dialect_qa"), "instruction", "output", "dialect")


_SCRIPT_SQL = f"case when {_A} > 0 and {_L} > 0 then 'mixed_script' when {_A} > 0 then 'arabic_script' when {_L} > 0 then 'arabizi' else 'uncertain' end"


@query(f"with t as (select source, {_SCRIPT_SQL} as label, text, row_number() over (partition by source, {_SCRIPT_SQL} order by {_KEY.format('doc_id')}, doc_id) as r from documents) select source, label, count(*) as n, md5(coalesce(array_to_string(list(text order by r) filter (where r <= 5), chr(10)), '')) as samples from t group by all")
def script_samples(spark, d):
    """Script classes of every source, with the hash of five texts of each."""
    rows = audit.class_samples(docs(spark, d), "source", C.detect_script(F.col("text")), "text", "doc_id")
    return rows.withColumn("samples", F.md5(F.array_join("samples", "\n")))


@query(f"with g as (select source, count(*) as examples, coalesce(sum({_ASSIST}), 0)::bigint as tokens from arabic_derja group by source) select source, examples, tokens, round(tokens * 100.0::double / sum(tokens) over (), 2) as pct from g")
def source_contributions(spark, d):
    """Answer tokens of every source and their share in per cent."""
    return audit.contributions(derja(spark, d), "source", M.tokens_assistant(F.col("messages")))


@query("select split as facet, coalesce(source, 'None') as value, count(*) as n from (select case split when 'train' then 'train' else 'holdout' end as split, source from arabic_derja where split in ('train', 'test')) group by all union all select 'check', 'overlap', (select count(*) from (select id from arabic_derja where split = 'train' and id is not null intersect select id from arabic_derja where split = 'test')) union all select 'check', 'unflagged', (select count(*) from arabic_derja where split in ('train', 'test') and not coalesce(code_switching, false))")
def selection_check(spark, d):
    """Counts by source of train and test, keys they share, and records that don't say they switch."""
    r = derja(spark, d).select("id", "source", "split", "code_switching")
    return audit.selection_check(r.where("split = 'train'"), r.where("split = 'test'"), flag=F.col("code_switching"))


_OPTIONAL = ["id", "messages", "category", "source", "language", "subcategory", "script", "code_switching", "difficulty", "variation_group", "split", "ingested_at"]


@query(" union all ".join(f"select '{c}' as field, count({c}) as filled, count(*) - count({c}) as missing from arabic_derja" for c in _OPTIONAL))
def field_presence(spark, d):
    return audit.field_presence(derja(spark, d), _OPTIONAL)


@query("with r as (select * from arabic_derja) select 'id' as path, 'STRING' as kind, count(id) as n from r union all select 'source', 'STRING', count(source) from r union all select 'messages', 'ARRAY', count(messages) from r union all select 'messages.role', case when m.role is null then 'MISSING' else 'STRING' end, count(*) from (select unnest(messages) as m from r) group by all union all select 'messages.content', case when m.content is null then 'MISSING' else 'STRING' end, count(*) from (select unnest(messages) as m from r) group by all")
def key_scan(spark, d):
    """Keys of the records as JSON, and the kinds of their values."""
    lines = derja(spark, d).select(F.to_json(F.struct("id", "source", "messages")).alias("_raw")).withColumn("v", F.try_parse_json("_raw"))
    return audit.key_scan(lines)


_LAST_ROLE = "messages[-1].role"
_TESTS = {
    "no_messages": "coalesce(len(messages), 0) = 0", "over_limit": f"{_TOTAL} > 512", "no_answer": f"len(messages) > 0 and not coalesce(list_contains({_ROLES}, 'assistant'), false)", "ends_without_answer": f"len(messages) > 0 and not coalesce({_LAST_ROLE} = 'assistant', false)",
    "blank_turn": f"len(messages) > 0 and len(list_filter(messages, lambda m: {_strip(_or_empty('m.content'))} = '')) > 0", "same_role_twice": f"len(messages) > 0 and len(list_filter(range(2, len(messages) + 1), lambda i: coalesce(messages[i].role = messages[i - 1].role, false))) > 0",
    "marker_in_text": r"len(messages) > 0 and len(list_filter(messages, lambda m: coalesce(regexp_matches(m.content, '<\|[a-z_]+\|>|</?s>|\[/?INST\]'), false))) > 0",
}


@query(" union all ".join(f"select '{k}' as finding, count_if({c}) as n from arabic_derja" for k, c in _TESTS.items()))
def data_doctor(spark, d):
    """Records that a trainer would cut or stumble over."""
    return audit.doctor(derja(spark, d), M.tokens_total(F.col("messages")), 512)


@query(f"with c as (select doc_id, {_A} as a, {_L} as l, {_hits('lower(text)', C.FRENCH_COMMON)} as fr, {_hits('lower(text)', audit.ENGLISH_COMMON)} as en, {_hits('lower(text)', C.TUNISIAN_MARKERS)} + len(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}\\p{{M}}_]+'), lambda w: regexp_full_match(w, '[a-z]*[379][a-z]+'))) as az from documents) select doc_id, case when a > l then 'ar' when az > fr and az > en then 'arabizi' when fr > en and fr > 0 then 'fr' when en > 0 then 'en' else 'unknown' end as lang from c")
def language_guess(spark, d):
    """Language of every document by markers alone."""
    return dear(docs(spark, d), "doc_id", "text").select("doc_id", audit.language_guess(F.col("text")).alias("lang"))


@query(f"select substr(sha256({_SYSTEM}), 1, 16) as template, least(count(*), 200) as kept, greatest(count(*) - 200, 0) as dropped, min(left({_SYSTEM}, 80)) as preview from arabic_derja group by 1")
def template_cap_counts(spark, d):
    """Records kept and dropped of every template at a cap of 200."""
    m = F.col("messages")
    return audit.cap_counts(derja(spark, d), M.template_key(m), 200, M.first_of(m, "system"))


@query(f"with p as (select line_no, category, {_TOTAL}::bigint as v, {_KEY.format('line_no')} as k from arabic_derja), s as (select *, coalesce(sum(v) over (partition by category order by k, line_no rows between unbounded preceding and 1 preceding), 0) as before from p), w as (select * from {_weights({'coding': 0.05, 'mathematics': 0.03, 'reasoning': 0.1})}) select line_no, category from s join w using (category) where before + v <= floor(w * (select sum(v) from p))")
def diversity_shares(spark, d):
    """Records by which each of three categories holds at most its share of all tokens."""
    pool = _pool(spark, d).select("line_no", "category", "tokens_total")
    return audit.within_shares(pool, "category", "tokens_total", {"coding": 0.05, "mathematics": 0.03, "reasoning": 0.1}, ident="line_no").select("line_no", "category")


@query("select case when v >= 2048 then 3 when v >= 512 then 2 when v >= 128 then 1 else 0 end as band, count(*) as n from (select " + _TOTAL + " as v from arabic_derja) group by 1")
def length_bands(spark, d):
    """Records in bands of length."""
    rows = derja(spark, d).select(M.tokens_total(F.col("messages")).alias("v"))
    return rows.groupBy(audit.length_bands(F.col("v"), [128, 512, 2048]).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with s as (select list_sort(list({_TOTAL})) as v, count(*) as n from arabic_derja) select n, " + ", ".join(f"v[floor(n * {q / 100})::int + 1]::bigint as p{q}" for q in (10, 25, 50, 75, 90, 95, 99)) + ", v[1]::bigint as least, v[-1]::bigint as most from s")
def token_percentiles(spark, d):
    return audit.token_percentiles(derja(spark, d), M.tokens_total(F.col("messages")))


_BODY_TEXT = "array_to_string(list_transform(messages, lambda m: coalesce(m.role, '') || ':' || coalesce(m.content, '')), chr(10))"


@query(f"with s as (select distinct sha256({_BODY_TEXT}) as k, split as s from arabic_derja where split is not null and messages is not null) select a.s as split_a, b.s as split_b, count(*) as shared from s a join s b on a.k = b.k and a.s < b.s group by all")
def cross_split_lines(spark, d):
    """Whole records that stand in two splits, by the hash of their text."""
    rows = derja(spark, d).where("messages is not null")
    text = F.array_join(F.transform("messages", lambda m: F.concat(F.coalesce(m["role"], F.lit("")), F.lit(":"), F.coalesce(m["content"], F.lit("")))), "\n")
    return mixture.line_overlap(rows, "split", text)


@query("with a as (select distinct id from raw_dialect_qa where id is not null), b as (select distinct id from arabic_derja where id is not null), n as (select (select count(*) from (select id from a except select id from b)) as only_a, (select count(*) from (select id from b except select id from a)) as only_b, (select count(*) from (select id from a intersect select id from b)) as shared) select *, only_a = 0 as subset, only_a = 0 and only_b = 0 as equal from n")
def key_relation(spark, d):
    """How the identifiers of the raw pool relate to those of the records."""
    return mixture.key_relation(table(spark, d, "raw_dialect_qa"), derja(spark, d))


@query("select id from raw_dialect_qa where id is not null union select id from arabic_derja where id is not null")
def union_of_keys(spark, d):
    return mixture.union_keys(table(spark, d, "raw_dialect_qa"), derja(spark, d))


@query("select count(*) as rows from arabic_derja where code_switching and coalesce(source in ('derja_majlis', 'souk_talk'), false) = false")
def switched_sub_corpora(spark, d):
    """Records that say they switch, some sub-corpora left out."""
    return mixture.code_switched(mixture.sub_corpora(derja(spark, d), "source", exclude=["derja_majlis", "souk_talk"])).agg(F.count(F.lit(1)).alias("rows"))


def _grams_sql(x: str) -> str:
    t = f"lower(regexp_replace({x}, '{_WS}+', ' ', 'g'))"
    return f"list_distinct(list_transform(range(1, greatest(length({t}) - 1, 1)), lambda i: substr({t}, i, 3)))"


@query(f"with g as (select id, {_grams_sql(_or_empty('instruction'))} as a, {_grams_sql(_or_empty('output'))} as b from raw_dialect_qa), n as (select id, len(list_intersect(a, b)) as s, len(a) as x, len(b) as y from g) select id, coalesce(s::double / nullif(x + y - s, 0), 0) as similarity from n")
def gram_similarity(spark, d):
    """Jaccard similarity of the three-character runs of question and answer."""
    q = table(spark, d, "raw_dialect_qa")
    i, o = (dedup.char_grams(F.coalesce(F.col(c), F.lit(""))) for c in ("instruction", "output"))
    return q.select("id", i.alias("a"), o.alias("b")).select("id", dedup.jaccard(F.col("a"), F.col("b")).alias("similarity"))


_SWITCH = f"case when lower(dialect) in ('mixed', 'french', 'tunisian_arabizi') then true when lower(dialect) in ('arabic', 'tunisian_arabic') then false else {_markers('t', C.FR_SWITCH_MARKERS)} > 0 and {_markers('t', C.AR_SWITCH_MARKERS)} > 0 end"


@query(f"with q as (select dialect, lower(concat(coalesce(instruction, ''), case when {_strip(_or_empty('input'))} <> '' then chr(10) || input else '' end, ' ', coalesce(output, ''))) as t from raw_dialect_qa) select case lower(dialect) " + " ".join(f"when '{k}' then '{v}'" for k, v in A.DIALECT_LANGUAGE.items()) + f" else 'mixed' end as language, {_SWITCH} as code_switching, count(*) as n from q group by all")
def dialect_pool(spark, d):
    """Languages and code-switching of the raw pool as canonical records."""
    return A.load_pool(table(spark, d, "raw_dialect_qa"), "dialect", "qa").groupBy("language", "code_switching").agg(F.count(F.lit(1)).alias("n"))


@query(f"select count(*) as rows, count_if(coalesce({_strip('instruction')} <> '' and {_strip('output')} <> '' and {_strip('input')} <> '' and output <> input, false)) as valid from raw_dialect_qa")
def dpo_format(spark, d):
    q = table(spark, d, "raw_dialect_qa").select(F.col("instruction").alias("prompt"), F.col("output").alias("chosen"), F.col("input").alias("rejected"))
    return formats.report(q, "dpo")


@query(f"select count(*) as rows, count_if(coalesce({_strip('instruction')} <> '' and {_strip('output')} <> '' and dialect is not null, false)) as valid from raw_dialect_qa")
def kto_format(spark, d):
    q = table(spark, d, "raw_dialect_qa").select(F.col("instruction").alias("prompt"), F.col("output").alias("completion"), F.col("dialect").alias("label"))
    return formats.report(q, "kto")


@query(f"select count(*) as rows, count_if(coalesce({_strip('text')} <> '', false)) as valid from documents")
def plaintext_format(spark, d):
    return formats.report(docs(spark, d), "plaintext")


@query(f"select doc_id, left(lang, 80) as lang, left(text, 80) as text from (select * from documents order by {_KEY.format('doc_id')}, doc_id limit 5)")
def inspect_rows(spark, d):
    """Five rows in stable order as a preview."""
    return audit.inspect(docs(spark, d), "doc_id", ["doc_id", "lang", "text"])


@query("select printf('syn-%06d', i) as id, (['mathematics', 'reasoning', 'coding', 'general_instruction', 'knowledge_qa'])[i % 5 + 1] as category, (['synthetic_a', 'synthetic_b'])[i % 2 + 1] as source, (['easy', 'medium', 'hard'])[(i // 5) % 3 + 1] as difficulty, printf('Answer %d: the number that follows is %d.', i, i * 7 + 1) as answer from range(1000) t(i)")
def synthetic_records(spark, d):
    """A thousand made-up records."""
    return synthetic.records(spark, 1000).select("id", "category", "source", "difficulty", M.last_of(F.col("messages"), "assistant").alias("answer"))


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
