"""Expressions over arrays of turns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions.text import blank, strip, token_estimate

ROLE_OUT = {"system": "system", "user": "human", "assistant": "gpt"}
ROLE_IN = {"system": "system", "human": "user", "user": "user", "gpt": "assistant", "assistant": "assistant", "model": "assistant"}
MESSAGES = "array<struct<role:string,content:string>>"


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def contents(messages: Column, sep: str = " ") -> Column:
    """All contents, joined; null ones are skipped."""
    return F.array_join(F.transform(messages, lambda m: m["content"]), sep)


def last_of(messages: Column, role: str) -> Column:
    return F.coalesce(F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))["content"], F.lit(""))


def first_of(messages: Column, role: str) -> Column:
    return F.coalesce(F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(1))["content"], F.lit(""))


def record_chars(messages: Column) -> Column:
    return F.coalesce(F.aggregate(messages, F.lit(0).cast("long"), lambda a, m: a + F.coalesce(F.length(m["content"]), F.lit(0))), F.lit(0).cast("long"))


def tokens_total(messages: Column) -> Column:
    """Estimated tokens and one for each turn."""
    return F.coalesce(F.aggregate(messages, F.lit(0).cast("long"), lambda a, m: a + token_estimate(m["content"]) + 1), F.lit(0).cast("long"))


def tokens_assistant(messages: Column) -> Column:
    return F.coalesce(F.aggregate(F.filter(messages, lambda m: m["role"] == "assistant"), F.lit(0).cast("long"), lambda a, m: a + token_estimate(m["content"])), F.lit(0).cast("long"))


def template_key(messages: Column) -> Column:
    """Sixteen digits of the hash of the system prompt."""
    return F.substring(F.sha2(first_of(messages, "system"), 256), 1, 16)


def canonical_messages(user: Column, assistant: Column, system: Column | None = None) -> Column:
    def turn(role: str, c: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), c.alias("content"))

    turns = [turn("user", user), turn("assistant", assistant)]
    if system is not None:
        turns.insert(0, F.when(F.coalesce(system, F.lit("")) != "", turn("system", system)))
    return F.filter(F.array(*turns), lambda m: m.isNotNull())


def to_sharegpt(messages: Column) -> Column:
    names = _map(ROLE_OUT)
    return F.transform(messages, lambda m: F.struct(F.try_element_at(names, m["role"]).alias("from"), m["content"].alias("value")))


def from_sharegpt(conversations: Column) -> Column:
    """Turns of known speakers, contents stripped."""
    names = _map(ROLE_IN)
    known = F.filter(conversations, lambda m: F.try_element_at(names, m["from"]).isNotNull())
    return F.transform(known, lambda m: F.struct(F.try_element_at(names, m["from"]).alias("role"), strip(F.coalesce(m["value"], F.lit(""))).alias("content")))


def sharegpt_to_alpaca(conversations: Column) -> Column:
    """Instruction, input and output: the first human turn instructs, a later one is input, the last answer is output."""

    def last(test) -> Column:
        return F.coalesce(F.try_element_at(F.filter(F.transform(conversations, lambda m, i: F.struct(m["from"].alias("f"), m["value"].alias("v"), i.alias("i"))), test), F.lit(-1))["v"], F.lit(""))

    human = lambda m: m["f"].isin("human", "user")
    return F.struct(
        last(lambda m: human(m) & (m["i"] == 0)).alias("instruction"),
        last(lambda m: human(m) & (m["i"] > 0)).alias("input"),
        last(lambda m: m["f"].isin("gpt", "assistant")).alias("output"),
        last(lambda m: m["f"] == "system").alias("system"),
    )


def from_text(text: Column) -> Column:
    """Sentences as alternating turns, closed by a fixed answer where the last turn is a user's; null for blank text."""
    t = strip(text)
    parts = F.filter(F.transform(F.split(F.replace(F.replace(t, F.lit("।"), F.lit(".")), F.lit("؟"), F.lit("?")), r"\. "), lambda p: strip(p)), lambda p: p != "")
    parts = F.when(F.size(parts) == 0, F.array(t)).otherwise(parts)
    turns = F.transform(parts, lambda p, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), p.alias("content")))
    closing = F.array(F.struct(F.lit("assistant").alias("role"), F.lit("فهمت.").alias("content")))
    return F.when(F.coalesce(t, F.lit("")) != "", F.when(F.size(parts) % 2 == 1, F.concat(turns, closing)).otherwise(turns))


def messages_valid(messages: Column) -> Column:
    """Cheap structural check: known roles, no blank content, user first and assistant last."""
    roles = F.transform(messages, lambda m: m["role"])
    body = F.when(F.try_element_at(roles, F.lit(1)) == "system", F.slice(roles, F.lit(2), F.greatest(F.size(roles) - 1, F.lit(0)))).otherwise(roles)
    ok = (
        (F.size(messages) >= 2)
        & (F.try_element_at(body, F.lit(1)) == "user")
        & (F.try_element_at(body, F.lit(-1)) == "assistant")
        & F.forall(messages, lambda m: F.coalesce(m["role"].isin("system", "user", "assistant"), F.lit(False)) & ~blank(F.coalesce(m["content"], F.lit(""))))
    )
    return F.coalesce(ok, F.lit(False))
