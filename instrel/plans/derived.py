"""Q&A, completion and package tables derived from the given Parquet tables.

Every document becomes one input: its text is the answer, and its words, cut into
consecutive runs that together are the whole text, are the passages. Each derived
table is a projection of its own source row, so building one never shuffles. The
id decides which defects are planted, so that every rule has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from instrel.constants import ERROR_TOO_FEW_NEGATIVES, FAILURE_MODES
from instrel.functions.once import with_once
from instrel.operators.parsing import explode_candidates
from instrel.operators.requests import INSTRUCTION_STAGE, PASSAGE_STAGE, assign_variant

# A package cites chunks c0..c8, of which c8 does not exist.
CHUNKS = 8

QUESTION = "concat('What does the ', lang, ' text ', id, ' from ', source, ' say?')"

# Every tenth instruction gives the answer away.
INSTRUCTION = """if(id % 10 = 0, concat('A relevant passage must say: ', text),
    concat('A relevant passage must name ', source, ' and be in ', lang))"""

# Six passages mostly, some packages have five, two or none.
PARTS = "case when id % 31 = 7 then 0 when id % 29 = 3 then 2 when id % 9 = 4 then 5 else 6 end"

MODE = "get(array({}), cast(if(id % 3 = 0, id * i % 6, (id + i) % 6) as int))".format(
    ", ".join(f"'{mode}'" for mode in FAILURE_MODES)
)

# Fields of passage i of a package.
FIELDS = {
    "id": "i",
    "label": """case when i = 0 and id % 41 = 5 then 'Positive'
        when i = 0 or (i = 1 and id % 37 = 1) then 'positive' else 'negative' end""",
    "neg_type": f"if(if(i = 0, id % 43 = 2, id % 59 <> 7), {MODE}, null)",
    "title": "concat('Text ', id, ' part ', i)",
    "passage": """array_join(slice(words, cast(size(words) * i div parts as int) + 1,
        cast(size(words) * (i + 1) div parts - size(words) * i div parts as int)), ' ')""",
    "explanation": f"""case when i = 0 then 'says what is asked for'
        when (id + i) % 27 <> 0 then concat({MODE}, ' - fails the instruction') end""",
    "why_relevant": """case when i = 0 and id % 23 <> 0 then 'maps to the instruction'
        when i = 2 and id % 47 = 3 then 'should not be here' end""",
    "confidence": """case when i = 0 then (60 + id * 37 % 41) / 100.0D when i = 1 and id % 53 = 9 then 1.2D
        else (id * 29 % 40 + (id * 6 + i) * 17 % 45) / 100.0D end""",
    "evidence": """if((id + i) % 4 = 0, cast(array() as array<string>), array(concat('c', (id + i) % 9)))""",
}


# Given, so that no job has to look into the files for them.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, question, answer, chunk: one input per document, some without an answer."""
    return documents(spark, sf_dir).selectExpr(
        "id", f"{QUESTION} as question",
        "if(id % 50 = 49, null, text) as answer",
        "if(id % 3 = 0, concat('Other texts come from ', source), null) as chunk",
    )


def conversation_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn right after it."""
    turns = table(spark, sf_dir, "conversations")
    users = turns.where("role = 'user'").selectExpr("conv_id", "turn", "text as question")
    answers = turns.where("role = 'assistant'").selectExpr("conv_id", "turn - 1 as turn", "text as answer")
    return users.join(answers, ["conv_id", "turn"]).selectExpr(
        "conv_id * 1000 + turn as id", "question", "answer"
    )


def done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that an earlier run has finished: the labelled documents."""
    return table(spark, sf_dir, "labels").selectExpr("doc_id as id")


def packages(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """Nested packages whose responses have the given fields only, as a scan of a
    stored nested table would read no others."""
    cut = documents(spark, sf_dir).selectExpr("*", f"{PARTS} as parts")
    if "passage" in fields:
        cut = with_once(cut, words=F.split("text", " "))
    members = ", ".join(f"'{name}', {FIELDS[name]}" for name in fields)
    numbers = "slice(array(0, 1, 2, 3, 4, 5), 1, parts)"
    built = with_once(cut, responses=F.expr(f"transform({numbers}, i -> named_struct({members}))"))
    return assign_variant(built).selectExpr(
        "id", "0 as choice_index", f"{QUESTION} as query", "text as og_positive",
        f"{INSTRUCTION} as instruction", "style", "length", "responses",
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage, with the query and instruction of its package."""
    return explode_candidates(packages(spark, sf_dir), "query", "instruction")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and confidence of every passage; no text is read for it."""
    return packages(spark, sf_dir, ("label", "confidence")).selectExpr("inline(responses)")


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorer output per candidate: true and false logits for both texts, ties included; some candidates have none."""
    return documents(spark, sf_dir).selectExpr(
        "id", "0 as choice_index", "explode(array(0, 1, 2, 3, 4, 5)) as pos"
    ).selectExpr("*", "id * 6 + pos as n").where("n % 101 <> 7").selectExpr(
        "id", "choice_index", "pos",
        "(n * 13 % 17 - 8) / 2.0D as q_true", "(n * 29 % 19 - 9) / 2.0D as q_false",
        "(n * 7 % 23 - 11) / 2.0D as i_true", "(n * 5 % 29 - 14) / 2.0D as i_false",
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source chunks c0..c7 of every package."""
    return documents(spark, sf_dir).selectExpr(
        "id", f"explode(sequence(0, {CHUNKS - 1})) as n"
    ).selectExpr("id", "concat('c', n) as chunk_id")


def _quoted(text: str) -> str:
    """Python source of a text, ``None`` for NULL."""
    escaped = f"replace(replace({text}, '\\\\', '\\\\\\\\'), '\\'', '\\\\\\'')"
    escaped = f"replace(replace({escaped}, '\\n', '\\\\n'), '\\r', '\\\\r')"
    return f"if({text} is null, 'None', concat('\\'', {escaped}, '\\''))"


_STRINGS = ("label", "neg_type", "title", "passage", "explanation", "why_relevant")


def _python_item() -> str:
    """Python source of passage ``r``, but for the score and the closing brace."""
    fields = [f"', \\'{name}\\': ', {_quoted('r.' + name)}" for name in _STRINGS]
    evidence = f"', \\'evidence\\': [', array_join(transform(r.evidence, e -> {_quoted('e')}), ', '), '], '"
    return f"concat('{{\\'id\\': ', r.id, {', '.join(fields)}, {evidence})"


def _json_item() -> str:
    """JSON of passage ``r``, but for the score and the closing brace."""
    members = ", ".join(f"'{name}', r.{name}" for name in ("id", *_STRINGS, "evidence"))
    return f"concat(rtrim('}}', to_json(named_struct({members}), map('ignoreNullFields', 'false'))), ', ')"


def _score(quote: str) -> str:
    """The score of passage ``r``: usually its confidence, see ``package_text``."""
    number = "cast(r.confidence as string)"
    return f"""case
        when id % 7 = 1 and r.id = 1 then concat('{quote}score{quote}: {quote}x{quote}, {quote}probability{quote}: ', {number})
        when id % 11 = 2 then concat('{quote}confidence{quote}: {quote}', {number}, '{quote}')
        else concat('{quote}confidence{quote}: ', {number}) end"""


def package_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages with ``response`` as text: JSON for even ids, a Python literal for odd ones.

    Planted, first that holds: truncated text (id % 17 = 3), a list element that is
    no object (id % 19 = 5), a single object (id % 13 = 6). Scores are texts where
    id % 11 = 2, and where id % 7 = 1 item 1 has a useless ``score`` and a
    ``probability`` instead of a confidence.
    """
    quoted = "\\'"
    as_json = "transform(responses, r -> concat({}, {}, '}}'))".format(_json_item(), _score('"'))
    as_python = "transform(responses, r -> concat({}, {}, '}}'))".format(_python_item(), _score(quoted))
    items = with_once(
        packages(spark, sf_dir), items=F.expr(f"array_join(if(id % 2 = 0, {as_json}, {as_python}), ', ')")
    )
    return items.selectExpr(
        "id", "choice_index", "query", "og_positive", "instruction",
        """case when id % 17 = 3 then concat('[', rtrim('}]', items))
            when id % 19 = 5 then concat('[', items, ', 5]')
            when id % 13 = 6 then '{"id":1,"label":"positive","confidence":0.4}'
            else concat('[', items, ']') end as response""",
    )


def instruction_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two choices per instruction request; some missing, some not JSON, some without the key."""
    base = assign_variant(documents(spark, sf_dir)).selectExpr("*", f"{INSTRUCTION} as said")
    return base.where("id % 17 <> 11").selectExpr("*", "explode(array(0, 1)) as choice_index").selectExpr(
        f"concat('{INSTRUCTION_STAGE}:', id) as request_id", "choice_index",
        """case when id % 16 = 5 then concat('{\\'instruction\\': ', said, '\\'}')
            when id % 21 = 4 then to_json(named_struct('text', said))
            else to_json(named_struct(
                'instruction', concat(said, if(choice_index = 0, '', ' (again)')),
                'style', case when id % 10 = 3 then 'other' when id % 10 <> 6 then style end,
                'length', if(id % 15 = 4, 'other', length))) end as content""",
    )


def passage_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two choices per passage request, the good ones with the whole package as JSON.

    Planted: none at all (id % 17 = 5), an error instead of passages (id % 13 = 0,
    choice 0), truncated JSON (id % 11 = 0, choice 1), no list (id % 37 = 8, choice 1).
    """
    good = "named_struct('query', query, 'instruction', instruction, 'examples', responses)"
    built = packages(spark, sf_dir).where("id % 17 <> 5").selectExpr(
        "id", f"to_json({good}, map('ignoreNullFields', 'false')) as good"
    )
    content = f"""case
        when id % 13 = 0 and choice_index = 0 then to_json(named_struct(
            'error', '{ERROR_TOO_FEW_NEGATIVES}', 'reason', 'too short', 'produced_negatives', id % 5))
        when id % 11 = 0 and choice_index = 1 then rtrim(']}}', good)
        when id % 37 = 8 and choice_index = 1 then '{{"examples":{{"id":0}}}}'
        else good end"""
    return built.selectExpr("id", "good", "explode(array(0, 1)) as choice_index").selectExpr(
        f"concat('{PASSAGE_STAGE}:', id) as request_id", "choice_index", f"{content} as content"
    )


def doc_partition_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions that name relevant and other documents; some overlap, some are empty."""
    return documents(spark, sf_dir).selectExpr(
        f"concat('{INSTRUCTION_STAGE}:', id) as request_id", "0 as choice_index",
        """to_json(named_struct(
            'instruction', concat('Must be by ', source),
            'relevant_docs', if(id % 8 = 3, cast(array() as array<int>), array(1)),
            'non_relevant_docs', case when id % 6 = 1 then array(2, 1) when id % 14 <> 2 then array(2) end
        )) as content""",
    )
