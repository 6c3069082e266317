"""Queries of the operators in this package, and SQL for those that SQL can express."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import capping, encode, forms, langid, leakage, lookalike, mixing, overlap, pairs, pii, tokens
from tamis.llm.labels import with_contributor
from tamis.tables import table


def p1_record_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of every record, with contributor, language and category."""
    per, _ = tokens.token_budget(table(spark, d, "arabic_derja"), table(spark, d, "source_catalog"))
    return per.select("line_no", "contributor", "language", "category", "turns", "tokens")


def p1_token_cube(spark: SparkSession, d: str) -> DataFrame:
    """Totals by contributor, language and category, built as a delta on an empty cube."""
    cells, _, _ = tokens.update_budget(table(spark, d, "arabic_derja"), table(spark, d, "source_catalog"))
    return tokens.cube(tokens.apply_cells(None, cells))


def p1_token_update(spark: SparkSession, d: str) -> DataFrame:
    """The cube of train and test after it held train and val: val is removed and test comes in by signed deltas."""
    records, catalog = table(spark, d, "arabic_derja"), table(spark, d, "source_catalog")
    before, state, counts = tokens.update_budget(records.where("split in ('train', 'val')"), catalog)
    moved, _, _ = tokens.update_budget(records.where("split in ('train', 'test')"), catalog, state, counts)
    return tokens.cube(tokens.apply_cells(tokens.apply_cells(None, before), moved))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Defective answers and their defect."""
    return pairs.defective_pairs(table(spark, d, "arabic_derja")).distinct()


#: Share of all rows above which a contributor dominates, and to which it is held.
DOMINANT = 0.05


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Every record with its contributor and score, and whether it stays when each contributor is held to a twentieth of all rows."""
    records, catalog = table(spark, d, "arabic_derja"), table(spark, d, "source_catalog")
    named = with_contributor(records.select("line_no", "source", "quality"), catalog).withColumn("score", capping.quality_score(F.col("quality")))
    return capping.judge_contributors(named.select("line_no", "source", "contributor", "score"), capping.every_limit(records, catalog, DOMINANT), F.col("score"), "line_no")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling of the dominant contributors: those of whom the radix selection gives up a record."""
    judged = _judged(spark, d).where("__c is not null").groupBy(F.col("__c").alias("contributor"), F.col("__row.source").alias("source")).agg(F.bool_or(~F.col("__kept")).alias("over"))
    big = judged.where("over").select("contributor").distinct()
    return judged.join(big, "contributor", "left_semi").select("source").distinct()


def p3_capped(spark: SparkSession, d: str) -> DataFrame:
    """The records that stay when each dominant contributor is held to a twentieth of all rows."""
    return _judged(spark, d).where("__kept").select("__row.line_no", "__row.contributor", "__row.score")


def _mixture(spark: SparkSession, d: str) -> mixing.Mixture:
    targets = table(spark, d, "mixture_targets")
    return mixing.Mixture(mixing.members(table(spark, d, "arabic_derja"), table(spark, d, "source_catalog"), targets), targets)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that cannot reach their target."""
    return _mixture(spark, d).short()


def p4_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The chosen records, how often each is used and for which source."""
    return _mixture(spark, d).selection().select("line_no", "source", "repeats")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source."""
    return _mixture(spark, d).report()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows of val or test and the rows of train that are nearly the same."""
    pairs = overlap.cross_split_pairs(table(spark, d, "arabic_derja"))
    return pairs.select(F.least("evaluation", "train").alias("line_a"), F.greatest("evaluation", "train").alias("line_b")).distinct()


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """Records that overlap across splits, with their class and its links."""
    return overlap.overlap_classes(table(spark, d, "arabic_derja"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlap by split and contributor."""
    return overlap.overlap_report(table(spark, d, "arabic_derja"), table(spark, d, "source_catalog"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages of records whose label is missing or wrong, or that are in several languages."""
    rows = langid.relabelled(table(spark, d, "arabic_derja"))
    cases = rows.where("right is not null and (label is null or label <> right or size(languages) > 1)")
    return cases.select("line_no", F.explode("languages.lang").alias("lang")).distinct()


def p6_labels(spark: SparkSession, d: str) -> DataFrame:
    """Found label of every record, with the confidence of each language."""
    rows = langid.relabelled(table(spark, d, "arabic_derja"))
    return rows.select("line_no", "label", F.col("right").alias("found"), F.explode_outer("languages").alias("l")).select("line_no", "label", "found", "l.lang", "l.sentences", F.round("l.confidence", 4).alias("confidence"))


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    """Language of every sentence of the user turns."""
    records = table(spark, d, "arabic_derja")
    return langid.segments(records, langid.fit(records)).drop("text")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows that look the same and differ in their characters."""
    return lookalike.lookalike_pairs(table(spark, d, "arabic_derja"))


def p7_classes(spark: SparkSession, d: str) -> DataFrame:
    """Records that look like others, with the class of their look."""
    return lookalike.lookalike_classes(table(spark, d, "arabic_derja"))


def p7_canonical(spark: SparkSession, d: str) -> DataFrame:
    """The canonical form of every content."""
    return lookalike.canonical_messages(table(spark, d, "arabic_derja"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.corpus_ids(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with 15 or more consecutive words of an item: those of the passages found that need no edit."""
    leaks = leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_prompts"))
    return leaks.where("edits = 0").select("doc_id", F.col("item").alias("item_id")).distinct()


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    """The same with passages that differ in one word."""
    leaks = leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_prompts"))
    return leaks.groupBy("doc_id", F.col("item").alias("item_id")).agg(F.min("edits").alias("edits"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Personal information as it stands in the documents."""
    return pii.find_pii(table(spark, d, "documents"), table(spark, d, "given_names")).distinct()


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every document with typed placeholders."""
    return pii.find_pii(table(spark, d, "documents"), table(spark, d, "given_names"), redact=True)


def queries() -> dict:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit()}


_KEY = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '^[a-z]+:', ''), '[@/].*$', ''), '[_\\-. ]v[0-9]+([.][0-9]+)*\\s*$', ''), '[^\\p{{L}}\\p{{N}}]', '', 'g')"
_NAMED = f"with c as (select source as contributor, {_KEY.format('source')} as k from source_catalog), r as (select a.*, c.contributor from arabic_derja a left join c on c.k = {_KEY.format('a.source')}), n as (select count(*) as total from r), d as (select contributor, total from r, n where contributor is not null group by contributor, total having count(*) > 0.05::double * total)"
_SIZE = "coalesce(list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))), 0)"


def _folded(x: str) -> str:
    """A content without case, marks, tatweel, look-alike and invisible characters, as SQL; full-width forms by rule."""
    wide = {0xFF01 + i: chr(0x21 + i) for i in range(0x5E)}
    pairs_ = {k: v for k, v in (forms.LOOKALIKE | wide | {0x640: None, 0x200D: None, 0x6CC: "ي", 0x649: "ي"}).items()}
    kept, gone = {k: v for k, v in pairs_.items() if v}, [k for k, v in pairs_.items() if not v]
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    once = f"translate({x}, {quote(''.join(map(chr, kept)) + ''.join(map(chr, gone)))}, {quote(''.join(kept.values()))})"
    return f"lower(strip_accents({once}))"


def _looks(x: str) -> str:
    """The look of a content as SQL: presentation forms, look-alikes, kinds of a space and invisible characters resolved, composed."""
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    forms_ = {c: unicodedata.normalize("NFKC", chr(c)) for a, b in ((0xFB00, 0xFB07), (0xFB50, 0xFDC8), (0xFE70, 0xFEFD), (0xFF01, 0xFFE7)) for c in range(a, b)}
    many = {chr(c): v for c, v in forms_.items() if len(v) > 1 and (c < 0xFB07 or c > 0xFEF4)}
    one = {c: v for c, v in forms_.items() if len(v) == 1 and v != chr(c)} | {k: v for k, v in forms.LOOKALIKE.items() if v}
    gone = [k for k, v in forms.LOOKALIKE.items() if not v] + [0x200D]
    for k, v in many.items():
        x = f"replace({x}, {quote(k)}, {quote(v)})"
    x = f"translate({x}, {quote(''.join(map(chr, one)) + ''.join(map(chr, gone)))}, {quote(''.join(one.values()))})"
    x = f"replace(regexp_replace({x}, 'ی(\\p{{M}}*[ء-ي])', 'ي\\1', 'g'), 'ی', 'ى')"
    return f"nfc_normalize({x})"


_WORDS = f"list_distinct(flatten(list_transform(list_filter(messages, lambda m: m.role in ('user', 'assistant') and m.content is not null), lambda m: regexp_extract_all({_folded('m.content')}, '[\\p{{L}}\\p{{N}}]+'))))"


def oracle_sql() -> dict[str, str]:
    score = "(case when quality.flagged then 0 else 27 end + 9 * case quality.synthetic when false then 2 when true then 0 else 1 end + 3 * case quality.reviewed when true then 2 when false then 0 else 1 end + case quality.native_authored when true then 2 when false then 0 else 1 end)::int"
    sizes = f", z as (select contributor, sum({_SIZE}) as size from r where split = 'train' group by 1), t as (select m.*, coalesce(z.size, 0) as size from mixture_targets m left join z on z.contributor = m.source)"
    near = f"with r as (select line_no, split = 'train' as train, {_WORDS} as w from arabic_derja where split in ('train', 'val', 'test') and len(messages) > 0), x as (select line_no, train, len(w) as n, unnest(w) as w from r), p as (select a.line_no as a, b.line_no as b, any_value(a.n) + any_value(b.n) - count(*) as whole, count(*) as shared from x a join x b on a.w = b.w and a.train and not b.train where a.n >= 0.79 * b.n and b.n >= 0.79 * a.n group by all) select least(a, b) as line_a, greatest(a, b) as line_b from p where shared >= 0.8::double * whole"
    words, grams = "regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}]+')", "list_transform(range(1, len(w) - 13), lambda i: array_to_string(w[i:i + 14], ' '))"
    return {
        "p5_found": near,
        "p5_report": f"{_NAMED}, f as ({near}), hit as (select line_a as line from f union select line_b from f) select split, coalesce(contributor, 'unknown') as contributor, count(*) as records, count(line) as overlapping, count(line) / count(*) as share from r left join hit on line = line_no where split in ('val', 'test') group by all",
        "p9_found": f"with d as (select doc_id, {words.format(_folded('text'))} as w from documents where text is not null), i as (select item_id, {words.format(_folded('prompt'))} as w from eval_prompts union all select item_id, {words.format(_folded('expected_behavior'))} from eval_prompts), dg as (select distinct doc_id, unnest({grams}) as g from d where len(w) >= 15), ig as (select distinct item_id, unnest({grams}) as g from i where len(w) >= 15) select distinct doc_id, item_id from dg join ig using (g)",
        "p7_found": f"with r as (select line_no, array_to_string(list_transform(messages, lambda m: m.role || chr(31) || coalesce({_looks('m.content')}, chr(30))), chr(29)) as look, array_to_string(list_transform(messages, lambda m: m.role || chr(31) || coalesce(m.content, chr(30))), chr(29)) as raw from arabic_derja where len(messages) > 0) select least(a.line_no, b.line_no) as line_a, greatest(a.line_no, b.line_no) as line_b from r a join r b on a.look = b.look and a.line_no < b.line_no and a.raw <> b.raw",
        "p3_found": f"{_NAMED} select distinct source from r where contributor in (select contributor from d)",
        "p3_capped": f"{_NAMED}, s as (select line_no, contributor, {score} as score from r), o as (select *, row_number() over (partition by contributor order by score desc, line_no) as k from s) select o.line_no, o.contributor, o.score from o left join d using (contributor) where d.total is null or k <= floor(0.05::double * d.total)",
        "p4_found": f"{_NAMED}{sizes} select source from t where size * max_repeat < target_share * (select sum(size) from t)",
    }
