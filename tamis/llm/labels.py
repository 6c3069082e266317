"""Contributors and language labels under their many spellings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.operators.joins import lookup_join
from tamis.session import cut

#: Stand-ins for a missing value, compared after trimming and lower-casing.
STAND_INS = ["", "-", "--", "?", "n/a", "na", "none", "null", "nan", "nil", "und", "unk", "unknown", "undefined", "tbd", "...", "…", "—", "–", "_"]
#: Spellings of the labels, after trimming, lower-casing and cutting a region.
LANGUAGE_NAMES = {
    "ar": ["ar", "ara", "arb", "aeb", "arabic", "arabe", "عربي", "العربية", "derja", "msa"],
    "arabizi": ["arabizi", "aeb-latn", "ar-latn", "ara-latn", "aeb_latn", "ar_latn", "arabish", "franco", "franco-arabic"],
    "fr": ["fr", "fra", "fre", "french", "francais", "français"],
    "en": ["en", "eng", "english", "anglais"],
    "mixed": ["mixed", "mix", "mul", "multi", "multiple", "code-switched", "code-switching"],
}
SCRIPT_NAMES = {"arabic": ["arabic", "arab"], "latin": ["latin", "latn"], "mixed": ["mixed"]}


def source_key(source: Column) -> Column:
    """A spelling of a contributor without host prefix, revision, shard path, case and separators."""
    s = F.lower(F.trim(source))
    s = F.regexp_replace(s, r"^[a-z]+:", "")
    s = F.regexp_replace(s, r"[@/].*$", "")
    s = F.regexp_replace(s, r"[_\-. ]v\d+(\.\d+)*\s*$", "")
    return F.regexp_replace(s, r"[^\p{L}\p{N}]", "")


def with_contributor(df: DataFrame, catalog: DataFrame, source: str = "source", to: str = "contributor") -> DataFrame:
    """Adds the proper name of the contributor, null where the spelling names none.

    The distinct spellings are matched, by a name as it stands and else by their key, and the rows look theirs up.
    A key that several names share tells none of them; they are matched as they stand only.
    """
    names = catalog.where("source is not null and source <> ''").select(F.col("source").alias("__name")).distinct()
    keyed = names.groupBy(source_key(F.col("__name")).alias("__key")).agg(F.min("__name").alias("__by_key"), F.count(F.lit(1)).alias("__n")).where("__n = 1 and __key <> ''").drop("__n")
    spelled = df.where(F.col(source).isNotNull()).select(F.col(source).alias("__spelled")).distinct()
    matched = spelled.join(names, F.col("__spelled") == F.col("__name"), "left").withColumn("__key", source_key(F.col("__spelled"))).join(keyed, "__key", "left")
    found = cut(matched.select("__spelled", F.coalesce("__name", "__by_key").alias("__found")).where("__found is not null"))
    named = lookup_join(df.withColumn("__spelled", F.col(source)), found, ["__spelled"], "left", salt_by=df.columns[0])
    return named.select(*[F.col(f"`{c}`") for c in df.columns if c != to], F.col("__found").alias(to))


def _named(label: Column, names: dict[str, list[str]]) -> Column:
    out = F.lit(None).cast("string")
    for name, spellings in names.items():
        out = F.when(label.isin(spellings), F.lit(name)).otherwise(out)
    return out


def language_label(language: Column) -> Column:
    """The canonical label, or null where it is missing, a stand-in or unheard of."""
    s = F.lower(F.regexp_replace(language, r"(?U)^\s+|\s+$", ""))
    s = F.when(s.rlike("^[a-z]{2,3}[-_]latn$"), s).otherwise(F.regexp_replace(s, r"^([a-z]{2,3})[-_].*$", "$1"))
    return _named(s, LANGUAGE_NAMES)


def script_label(script: Column) -> Column:
    return _named(F.lower(F.trim(script)), SCRIPT_NAMES)
