"""Package text to nested packages, and nested packages to candidate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instrel.functions.json_text import plain_items, raw_items
from instrel.functions.literals import literal_as_json, literal_tokens, tokens_as_json
from instrel.functions.nested import members
from instrel.functions.once import with_once
from instrel.functions.scores import is_score, probe_score, try_score


def parse_items(
    df: DataFrame, text: str = "response", mode: str = "auto", drop_non_dict: bool = False
) -> DataFrame:
    """Add ``items``, the passages as ``array<map<string,string>>``; NULL where the text is unusable.

    ``json`` reads JSON only, ``literal`` Python literals only (a single value
    counts as a list of one), ``auto`` JSON first and literals where that fails.
    A list element that is no object makes the whole package unusable, unless
    ``drop_non_dict`` leaves such elements out.
    """
    if mode not in ("auto", "json", "literal"):
        raise ValueError("mode is auto, json or literal")

    def read(df: DataFrame, name: str, column: str) -> DataFrame:
        # Each step is a column of its own, as what follows refers to it several times.
        plain = with_once(with_once(df, _raw=raw_items(F.col(column))), **{name: plain_items(F.col("_raw"))}).drop("_raw")
        if not drop_non_dict:
            return plain
        # Only lists that hold something else than objects are read again, member by member.
        rest = F.when(F.col(name).isNull(), F.col(column))
        some = with_once(plain, _some=raw_items(rest, drop_non_dict=True))
        return with_once(some, **{name: F.coalesce(F.col(name), plain_items(F.col("_some")))}).drop("_some")

    if mode == "json":
        return read(df, "items", text)
    single = mode == "literal"
    unread = F.lit(True)
    if mode == "auto":
        df = read(df, "_json", text)
        unread = F.col("_json").isNull()
    # Literals are spelled as JSON by column functions; Python gets only the texts that this does not read.
    df = with_once(df, _tokens=F.when(unread, literal_tokens(F.col(text))))
    spelled, alone = tokens_as_json(F.col("_tokens")), F.startswith(F.get("_tokens", F.lit(0)), F.lit("{"))
    if single:
        spelled = F.when(alone, F.concat(F.lit("["), spelled, F.lit("]"))).otherwise(spelled)
    df = read(with_once(df, _spelled=spelled), "_literal", "_spelled")
    if single:  # The brackets were put around one value, not around several or a part of a list.
        one = ~alone | ((F.size("_literal") == 1) & F.endswith(text, F.lit("}")))
        df = df.withColumn("_literal", F.when(one, F.col("_literal")))
    rest = F.when(unread & F.col("_literal").isNull(), F.col(text))
    df = df.withColumn("_rest", literal_as_json(wrap_single=single, drop_non_dict=drop_non_dict)(rest))
    df = read(df, "_python", "_rest")
    found = [F.col(c) for c in ("_json", "_literal", "_python") if c in df.columns]
    return df.withColumn("items", F.coalesce(*found)).drop("_json", "_tokens", "_spelled", "_literal", "_rest", "_python")


def _field(item: Column, key: str, default: Column) -> Column:
    """The key's value, NULL included; the default only where the key is absent."""
    return F.when(F.map_contains_key(item, F.lit(key)), item[key]).otherwise(default)


def _evidence(item: Column) -> Column:
    return F.from_json(item["evidence"], "array<string>")


def typed_response(item: Column, score: Column) -> Column:
    """Response struct of a package item, with the usual values for absent keys."""
    empty, null = F.lit(""), F.lit(None).cast("string")
    return F.struct(
        _field(item, "id", F.lit("0")).try_cast("int").alias("id"),
        _field(item, "label", empty).alias("label"),
        _field(item, "neg_type", null).alias("neg_type"),
        _field(item, "title", empty).alias("title"),
        _field(item, "passage", empty).alias("passage"),
        _field(item, "explanation", null).alias("explanation"),
        _field(item, "why_relevant", null).alias("why_relevant"),
        score.alias("confidence"),
        _evidence(item).alias("evidence"),
    )


def to_responses(parsed: DataFrame, scores: str = "default") -> DataFrame:
    """Replace ``items`` by ``responses``.

    ``default`` scores an absent confidence 0, ``probe`` takes the first score
    key that holds a number and leaves out items that have none.
    """
    if scores == "default":
        responses = F.transform(
            "items",
            lambda item: typed_response(item, try_score(_field(item, "confidence", F.lit("0.0")))),
        )
    elif scores == "probe":
        scored = F.filter("items", lambda item: probe_score(item).isNotNull())
        responses = F.transform(scored, lambda item: typed_response(item, probe_score(item)))
    else:
        raise ValueError("scores is default or probe")
    return parsed.withColumn("responses", responses).drop("items")


def package_reason(items: Column) -> Column:
    """Why a parsed package cannot be analysed, NULL if it can."""
    return (
        F.when(items.isNull(), "bad_package")
        .when(~F.forall(items, lambda item: is_score(try_score(item["confidence"]))), "no_confidence")
        .when(~F.forall(items, lambda item: F.map_contains_key(item, F.lit("label"))), "no_label")
    )


def strict_packages(parsed: DataFrame) -> DataFrame:
    """Packages every item of which has a number as confidence and a label."""
    return parsed.where(package_reason(F.col("items")).isNull())


def parse_rejects(parsed: DataFrame, stage: str = "parse", text: str = "response") -> DataFrame:
    """The other packages, as reject rows."""
    marked = parsed.withColumn("reason", package_reason(F.col("items")))
    return marked.where(F.col("reason").isNotNull()).select(
        F.lit(stage).alias("stage"),
        F.col("id").cast("string").alias("id"),
        "choice_index", "reason",
        F.col(text).alias("raw"),
    )


CANDIDATE_FIELDS = ("id", "title", "passage", "label", "neg_type", "explanation", "confidence")


def explode_candidates(
    packages: DataFrame, *carry: str, fields: tuple[str, ...] = CANDIDATE_FIELDS
) -> DataFrame:
    """One row per passage: package key, position and fields; empty packages give none.

    The passage's own id becomes ``item_id``. Only the given fields are read.
    """
    keys = ["id", "choice_index", *carry]
    return packages.select(*keys, F.posexplode(members("responses", *fields)).alias("pos", "r")).select(
        *keys, "pos", *[F.col(f"r.{c}").alias("item_id" if c == "id" else c) for c in fields]
    )
