"""The registered queries once more, as SQL for a single-node check.

Written from the meaning of each operator, not from its Spark plan: ranks where
Spark uses array functions, edges where it corrects bins, ids where it parses text.
"""

from __future__ import annotations

from instrel.constants import FAILURE_MODES, LENGTHS, SCORER_TEMPLATE, STYLES
from instrel.plans.catalog import PROMPTS


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items: list[str]) -> str:
    return "[" + ", ".join(_quote(item) for item in items) + "]"


def _choice(key: str, salt: str, options: list[str]) -> str:
    number = f"cast('0x' || substr(md5(cast({key} as varchar) || '{salt}'), 1, 8) as bigint)"
    return f"list_extract({_list(options)}, cast({number} % {len(options)} as int) + 1)"


def _filled(template: str, **holes: str) -> str:
    text = _quote(template.removesuffix("\n"))
    for name, value in holes.items():
        text = f"replace({text}, '{{{{{name}}}}}', {value})"
    return text


_STYLE = _choice("id", "style", STYLES)
_LENGTH = _choice("id", "length", LENGTHS)
_QUESTION = "'What does the ' || lang || ' text ' || cast(id as varchar) || ' from ' || source || ' say?'"

# Inputs, packages and passages.
_BASE = f"""base as (
  select doc_id as id, text, lang, source, {_QUESTION} as query,
    case when doc_id % 10 = 0 then 'A relevant passage must say: ' || text
         else 'A relevant passage must name ' || source || ' and be in ' || lang end as instruction,
    case when doc_id % 31 = 7 then 0 when doc_id % 29 = 3 then 2 when doc_id % 9 = 4 then 5 else 6 end as parts,
    string_split(text, ' ') as words
  from (select *, doc_id as id from documents)
)"""

_QA = f"""qa as (
  select doc_id as id, {_QUESTION} as question, case when doc_id % 50 <> 49 then text end as answer,
    case when doc_id % 3 = 0 then 'Other texts come from ' || source end as chunk
  from (select *, doc_id as id from documents)
)"""

_CONV = """qa as (
  select u.conv_id * 1000 + u.turn as id, u.text as question, a.text as answer
  from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
  where u.role = 'user' and a.role = 'assistant'
)"""

_PASSAGES = f"""{_BASE}, numbered as (
  select *, unnest(range(parts)) as i from base
), moded as (
  select *, list_extract({_list(FAILURE_MODES)},
    cast(case when id % 3 = 0 then id * i % 6 else (id + i) % 6 end as int) + 1) as mode
  from numbered
), passages as (
  select id, query, instruction, cast(i as int) as pos, cast(i as int) as item_id,
    case when i = 0 then case when id % 41 = 5 then 'Positive' else 'positive' end
         when i = 1 and id % 37 = 1 then 'positive' else 'negative' end as label,
    case when i = 0 then case when id % 43 = 2 then mode end when id % 59 <> 7 then mode end as neg_type,
    'Text ' || cast(id as varchar) || ' part ' || cast(i as varchar) as title,
    coalesce(array_to_string(words[len(words) * i // parts + 1 : len(words) * (i + 1) // parts], ' '), '') as passage,
    case when i = 0 then 'says what is asked for'
         when (id + i) % 27 <> 0 then mode || ' - fails the instruction' end as explanation,
    case when i = 0 and id % 23 <> 0 then 'maps to the instruction'
         when i = 2 and id % 47 = 3 then 'should not be here' end as why_relevant,
    case when i = 0 then (60 + id * 37 % 41) / 100.0 when i = 1 and id % 53 = 9 then 1.2
         else (id * 29 % 40 + (id * 6 + i) * 17 % 45) / 100.0 end as confidence,
    case when (id + i) % 4 <> 0 then 'c' || cast((id + i) % 9 as varchar) end as evidence
  from moded
), scored as (
  select id, pos, label, case when label = 'positive' then 'positive' else 'negative' end as label_class,
    cast(confidence as double) as x from passages
)"""

_LOGITS = """logits as (
  select doc_id as id, cast(i as int) as pos,
    ((doc_id * 6 + i) * 13 % 17 - 8) / 2.0 as qt, ((doc_id * 6 + i) * 29 % 19 - 9) / 2.0 as qf,
    ((doc_id * 6 + i) * 7 % 23 - 11) / 2.0 as it, ((doc_id * 6 + i) * 5 % 29 - 14) / 2.0 as jf
  from (select doc_id, unnest(range(6)) as i from documents) where (doc_id * 6 + i) % 101 <> 7
)"""

_ROUTED = f"""{_PASSAGES}, {_LOGITS}, routed as (
  select p.*, l.*exclude (id, pos),
    case when qt is null then 'unscored' when label = 'positive' and qt > qf and it > jf then 'valid_positive'
         when label = 'positive' then 'discarded_positive'
         when label = 'negative' and qt > qf and it <= jf then 'valid_negative'
         when label = 'negative' then 'discarded_negative' else 'unlabelled' end as bucket
  from passages p left join logits l using (id, pos)
)"""

# What the planted defects of the package texts do to each package.
_TEXT = f"""{_PASSAGES}, fate as (
  select id, parts, id % 17 = 3 as truncated, id % 17 <> 3 and id % 19 = 5 as mixed,
    id % 17 <> 3 and id % 19 <> 5 and id % 13 = 6 as single,
    not (id % 17 = 3 or id % 19 = 5 or id % 13 = 6) as sound from base
)"""

_FIELDS = "p.id, 0 as choice_index, p.pos, p.item_id, p.title, p.passage, p.label, p.neg_type, p.explanation"
_DEFAULT_SCORE = "case when p.id % 7 = 1 and p.pos = 1 then 0.0 else p.confidence end"

_STATS = """count(*) as {count}, round(avg(x), 6) as mean, round(quantile_cont(x, 0.5), 6) as median,
    round(stddev_pop(x), 6) as std, round(min(x), 6) as min, round(max(x), 6) as max,
    round(quantile_cont(x, 0.25), 6) as q25, round(quantile_cont(x, 0.75), 6) as q75"""

# Moments from deviations, per label class and overall.
_GROUPED = f"""{_PASSAGES}, grouped as (
  select label_class, x from scored union all select 'overall', x from scored
), centred as (
  select label_class, x, x - avg(x) over (partition by label_class) as d from grouped
), moments as (
  select label_class, count(*) as n, avg(d * d) as m2, avg(d * d * d) as m3, avg(d * d * d * d) as m4
  from centred group by label_class
), shape as (
  select label_class, n, m2,
    case when n < 3 or m2 = 0 then 0.0 else m3 / m2 ** 1.5 end as skewness,
    case when n < 4 or m2 = 0 then 0.0 else m4 / (m2 * m2) - 3 end as kurtosis
  from moments
)"""

_BINNED = f"""{_PASSAGES}, span as (
  select case when min(x) = max(x) then min(x) - 0.5 else min(x) end as lo,
         case when min(x) = max(x) then max(x) + 0.5 else max(x) end as hi, count(*) as total from scored
), edges as (
  select b as bin, lo + b * ((hi - lo) / 50) as bin_start,
    case when b = 49 then hi else lo + (b + 1) * ((hi - lo) / 50) end as bin_end, total
  from span, unnest(range(50)) as t(b)
), binned as (
  select bin, bin_start, bin_end, total, count(x) as count
  from edges left join scored on x >= bin_start and (x < bin_end or (bin = 49 and x <= bin_end))
  group by all
)"""

_SELECTED = f"""{_PASSAGES}, high as (
  select *, row_number() over (partition by id order by confidence desc, pos) as r
  from passages where confidence >= 0.7
), low as (
  select *, row_number() over (partition by id order by confidence, pos) - 1 as rank
  from passages where confidence <= 0.3
), chosen as (
  select b.id, b.query, h.pos as top_pos, h.confidence as top_confidence,
    coalesce(l.n, 0) as negatives, coalesce(l.pos, '') as bottom_pos, coalesce(l.confidences, '') as confidences, b.parts
  from base b left join high h on h.id = b.id and h.r = 1
  left join (
    select id, count(*) as n, string_agg(cast(pos as varchar), ',' order by rank) as pos,
      string_agg(printf('%.3f', cast(confidence as double)), ', ' order by rank) as confidences
    from low where rank < 3 group by id
  ) l on l.id = b.id
)"""

_SOFTMAX = "round(exp(greatest({t}, {f})) / (exp({t}) + exp({f})), 6)"

# Fates of the requests.
_INSTRUCTED = f"""{_QA}, {_BASE}, instruction_fate as (
  select b.id, case when answer is null then 'missing_text' when b.id % 17 = 11 then 'no_completion'
    when b.id % 16 = 5 then 'bad_json' when b.id % 21 = 4 then 'no_instruction' end as reason,
    {_STYLE.replace('id as', 'b.id as')} as style, {_LENGTH.replace('id as', 'b.id as')} as length, b.instruction
  from qa join base b using (id)
)"""

_CHOICES = """choices as (
  select id, c as choice_index,
    case when id % 13 = 0 and c = 0 then 'error_envelope' when id % 11 = 0 and c = 1 then 'bad_json'
         when id % 37 = 8 and c = 1 then 'no_examples' end as reason
  from (select doc_id as id, unnest([0, 1]) as c from documents where doc_id % 17 <> 5)
), broken as (
  select distinct id from choices where reason in ('error_envelope', 'no_examples')
)"""

_REJECTED = f"""{_INSTRUCTED}, {_CHOICES}, ready as (
  select id from instruction_fate where reason is null
), rejected as (
  select 'instruction' as stage, cast(id as varchar) as id,
    cast(case when reason in ('bad_json', 'no_instruction') then 0 end as int) as choice_index, reason
  from instruction_fate where reason is not null
  union all
  select 'passages', cast(id as varchar), choice_index, coalesce(reason, 'row_lost') from choices
  where id in (select id from ready) and (reason is not null or id in (select id from broken))
  union all
  select 'passages', cast(id as varchar), null, 'no_completion' from ready where id % 17 = 5
)"""

_FIRST_STATS = _STATS.format(count="total_responses")

_ANSWER = "trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'))"


def _normalised(column: str) -> str:
    return _ANSWER.replace("text", column)


ORACLE: dict[str, str] = {
    "limit_rows": f"with {_CONV} select id, question, answer from qa order by id limit 20",
    "pending_rows": f"""with {_QA} select id, question, answer from qa
        where id not in (select doc_id from labels)""",
    "run_metrics": """select count(*) as total_rows, count(*) as processed_rows,
        count(*) filter (doc_id % 31 <> 7) as output_rows, count(*) filter (doc_id % 31 = 7) as failed_rows
        from documents""",
    "first_row_stats": f"with {_PASSAGES} select {_FIRST_STATS} from scored where id = (select min(id) from base)",
    "read_packages_csv": f"""with {_TEXT}
        select b.id, b.query, b.text as og_positive, b.instruction, cast(case when f.sound then b.parts end as int) as passages
        from base b join fate f using (id)""",
    "read_qa_csv": f"with {_QA} select id, question, answer, chunk from qa",
    "append_packages": f"with {_BASE} select id, cast(parts as int) as passages from base",
    "stream_requests": f"""with {_QA} select 'instruction:' || cast(id as varchar) as request_id, id,
        {_STYLE} as style, {_LENGTH} as length,
        {_filled(PROMPTS.instruction_template, Question="question", Response="answer",
                 OtherDocs="coalesce(chunk, '')", STYLE=_STYLE, LENGTH=_LENGTH)} as prompt
        from qa where answer is not null""",
    "style_length_assign": f"with {_CONV} select id, {_STYLE} as style, {_LENGTH} as length from qa",
    "instruction_prompts": f"""with {_QA} select id,
        {_filled(PROMPTS.instruction_template, Question="question", Response="answer",
                 OtherDocs="coalesce(chunk, '')", STYLE=_STYLE, LENGTH=_LENGTH)} as prompt
        from qa where answer is not null""",
    "passage_prompts": f"""with {_BASE} select id,
        {_filled(PROMPTS.passage_template, Query="query", Instruction="instruction", SourceChunks="''")} as prompt
        from base""",
    "requests": f"""with {_CONV} select 'instruction:' || cast(id as varchar) as request_id,
        {_quote(PROMPTS.model)} as model, 'json_object' as format, 'user' as first_role,
        {_filled(PROMPTS.instruction_template, Question="question", Response="answer",
                 OtherDocs="''", STYLE=_STYLE, LENGTH=_LENGTH)} as first_content,
        'system' as second_role, {_quote(PROMPTS.instruction_system)} as second_content from qa""",
    "instruction_intake": f"""with {_INSTRUCTED} select id, style, length, instruction
        from instruction_fate where reason is null""",
    "passage_intake": f"""with {_BASE}, {_CHOICES} select id, choice_index, cast(parts as int) as passages
        from choices join base using (id) where reason is null and id not in (select id from broken)""",
    "passage_intake_skip_choice": f"with {_CHOICES} select id, choice_index from choices where reason is null",
    "packages": f"""with {_PASSAGES}, {_INSTRUCTED.replace(_BASE + ", ", "")}, {_CHOICES}
        select p.id, c.choice_index, p.query, p.instruction, f.style, f.length, p.pos, p.label, p.passage,
          cast(p.confidence as double) as confidence
        from passages p join choices c using (id) join instruction_fate f using (id)
        where f.reason is null and c.reason is null and id not in (select id from broken)""",
    "intake_rejects": f"with {_REJECTED} select stage, id, choice_index, reason from rejected",
    "parse_json_packages": f"""with {_TEXT} select {_FIELDS}, cast({_DEFAULT_SCORE} as double) as confidence
        from passages p join fate f using (id) where f.sound and p.id % 2 = 0""",
    "parse_literal_packages": f"""with {_TEXT} select {_FIELDS}, cast({_DEFAULT_SCORE} as double) as confidence
        from passages p join fate f using (id) where f.sound and p.id % 2 = 1
        union all select id, 0, 0, 1, '', '', 'positive', null, null, 0.4 from fate where single""",
    "candidates": f"""with {_TEXT} select {_FIELDS}, cast({_DEFAULT_SCORE} as double) as confidence
        from passages p join fate f using (id) where f.sound""",
    "confidence_strict": f"""with {_TEXT} select p.id, p.pos, p.label, cast(p.confidence as double) as confidence
        from passages p join fate f using (id) where f.sound and not (p.id % 7 = 1)""",
    "confidence_probe": f"""with {_TEXT} select p.id, p.item_id, cast(p.confidence as double) as confidence
        from passages p join fate f using (id) where f.sound or f.mixed""",
    "parse_rejects": f"""with {_TEXT} select id, case when not sound then 'bad_package' else 'no_confidence' end as reason
        from fate where not sound or (id % 7 = 1 and parts > 1)""",
    "label_class": f"""with {_PASSAGES} select label, label_class, count(*) as n from scored
        group by label, label_class""",
    "overall_confidence_stats": f"with {_PASSAGES} select {_FIRST_STATS} from scored",
    "label_confidence_stats": f"""with {_GROUPED}, basic as (
          select label_class, {_STATS.format(count="count")} from grouped group by label_class
        ) select label_class, count, mean, median, std, min, max, q25, q75, round(m2, 6) as variance,
          round(skewness, 6) as skewness, round(kurtosis, 6) as kurtosis,
          round(100.0 * count / (select count(*) from scored), 6) as percentage
        from basic join shape using (label_class)""",
    "label_share": f"""with {_PASSAGES} select label_class, count(*) as count,
        round(100.0 * count(*) / (select count(*) from scored), 6) as percentage from scored group by label_class""",
    "confidence_skewness": f"with {_GROUPED} select label_class, round(skewness, 6) as skewness from shape",
    "confidence_kurtosis": f"with {_GROUPED} select label_class, round(kurtosis, 6) as kurtosis from shape",
    "responses_per_query": f"""with {_BASE} select count(*) as packages, round(avg(parts), 6) as avg_responses,
        cast(max(parts) as int) as max_responses, cast(min(parts) as int) as min_responses from base""",
    "query_level_distribution": f"""with {_PASSAGES}, per as (
          select b.id, coalesce(bool_or(x >= 0.7), false) as hi, coalesce(bool_or(x <= 0.3), false) as lo
          from base b left join scored s using (id) group by b.id
        ) select count(*) as packages, count(*) filter (hi) as with_positive, count(*) filter (lo) as with_negative,
          count(*) filter (hi and lo) as with_both,
          round(100.0 * count(*) filter (hi) / count(*), 6) as positive_percent,
          round(100.0 * count(*) filter (lo) / count(*), 6) as negative_percent,
          round(100.0 * count(*) filter (hi and lo) / count(*), 6) as both_percent from per""",
    "confidence_histogram": f"""with {_BINNED} select bin, round(bin_start, 6) as bin_start,
        round(bin_end, 6) as bin_end, count, total from binned""",
    "confidence_density": f"""with {_BINNED} select bin, round(bin_start, 6) as bin_start,
        round(bin_end, 6) as bin_end, round(count / (total * (bin_end - bin_start)), 6) as density from binned""",
    "confidence_box": f"""with {_PASSAGES}, q as (
          select quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median, quantile_cont(x, 0.75) as q3 from scored
        ), marked as (
          select x, q1, median, q3,
            x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside from scored, q
        ) select count(*) as count, round(any_value(q1), 6) as q1, round(any_value(median), 6) as median,
          round(any_value(q3), 6) as q3, round(min(x) filter (inside), 6) as whisker_low,
          round(max(x) filter (inside), 6) as whisker_high, count(*) filter (not inside) as outliers from marked""",
    "confidence_ecdf": f"""with {_GROUPED} select distinct label_class, x as score,
        count(*) over (partition by label_class, x) as n,
        round(count(*) over (partition by label_class order by x)
          / count(*) over (partition by label_class), 6) as share from grouped""",
    "top_positive": f"""with {_SELECTED} select b.id, h.pos, cast(h.confidence as double) as confidence, h.label, h.passage
        from base b left join high h on h.id = b.id and h.r = 1""",
    "top_positive_labelled": f"""with {_SELECTED}, labelled as (
          select *, row_number() over (partition by id order by confidence desc, pos) as k
          from high where label = 'positive'
        ) select b.id, h.pos, cast(h.confidence as double) as confidence
        from base b left join labelled h on h.id = b.id and h.k = 1""",
    "bottom_negatives": f"""with {_SELECTED} select id, cast(rank as int) as rank, pos,
        cast(confidence as double) as confidence, passage from low where rank < 3""",
    "filter_responses": f"""with {_SELECTED} select id, query, top_pos, bottom_pos,
        cast(parts as int) as passages from chosen""",
    "selection_summary": f"""with {_SELECTED} select 0.7 as positive_threshold, 0.3 as negative_threshold,
        count(*) as total_queries, count(top_pos) as with_positive, count(*) filter (negatives > 0) as with_negatives,
        round(100.0 * count(top_pos) / count(*), 6) as positive_percent,
        round(100.0 * count(*) filter (negatives > 0) / count(*), 6) as negative_percent from chosen""",
    "selection_preview": f"""with {_SELECTED} select id, 0 as choice_index, substr(query, 1, 100) || '...' as query_preview,
        round(cast(top_confidence as double), 3) as top_confidence, cast(negatives as int) as negatives,
        confidences as negative_confidences from chosen order by id limit 3""",
    "relevance_pairs": f"""with {_PASSAGES} select id, pos, kind,
        {_quote(SCORER_TEMPLATE.split("{query}")[0])} || case when kind = 'query' then query
          else query || ' ' || instruction end
        || {_quote(SCORER_TEMPLATE.split("{query}")[1].split("{text}")[0])} || passage as text
        from passages, (values ('query'), ('instruction')) as k(kind)""",
    "relevance_verdict": f"""with {_LOGITS} select id, pos, qt > qf as query_relevant,
        {_SOFTMAX.format(t="qt", f="qf")} as query_score, it > jf as instruction_relevant,
        {_SOFTMAX.format(t="it", f="jf")} as instruction_score from logits""",
    "route_candidates": f"""with {_ROUTED} select id, pos, label, qt > qf as query_relevant,
        {_SOFTMAX.format(t="qt", f="qf")} as query_score, it > jf as instruction_relevant,
        {_SOFTMAX.format(t="it", f="jf")} as instruction_score, bucket from routed""",
    "filter_summary": f"""with {_ROUTED} select count(*) filter (bucket like 'valid%') as passages_kept,
        count(*) filter (bucket = 'valid_positive') as valid_positives,
        count(*) filter (bucket = 'valid_negative') as valid_negatives,
        count(*) filter (bucket = 'discarded_positive') as discarded_positives,
        count(*) filter (bucket = 'discarded_negative') as discarded_negatives,
        count(*) filter (bucket = 'unscored') as unscored from routed where label in ('positive', 'negative')""",
    "check_counts": f"""with {_PASSAGES}, per as (
          select b.id, cast(count(*) filter (label = 'positive') as int) as positives,
            cast(count(*) filter (label = 'negative') as int) as negatives
          from base b left join passages p using (id) group by b.id
        ) select *, positives = 1 and negatives = 5 as ok from per""",
    "check_word_length": f"""with {_PASSAGES}, counted as (
          select id, pos, label, cast(len(regexp_extract_all(passage, '\\S+')) as int) as words from passages
        ) select *, case when label = 'positive' then words between 80 and 150
          when label = 'negative' then words between 60 and 140 end as ok from counted""",
    "check_failure_modes": f"""with {_PASSAGES}, per as (
          select b.id, cast(count(distinct neg_type) filter (label = 'negative' and not (pos = 2 and b.id % 67 = 3)) as int) as distinct_modes,
            cast(count(*) filter (label = 'negative' and pos = 2 and b.id % 67 = 3) as int) as unknown_modes
          from base b left join passages p using (id) group by b.id
        ) select id, distinct_modes, unknown_modes, distinct_modes >= 4 and unknown_modes = 0 as ok from per""",
    "check_fields": f"""with {_PASSAGES} select b.id,
        cast(count(*) filter (confidence < 0 or confidence > 1) as int) as bad_confidence,
        cast(count(*) filter (label = 'positive' and neg_type is not null) as int) as positive_with_neg_type,
        cast(count(*) filter (label = 'positive' and why_relevant is null) as int) as positive_without_why,
        cast(count(*) filter (label = 'negative' and neg_type is null) as int) as negative_without_neg_type,
        cast(count(*) filter (label = 'negative' and why_relevant is not null) as int) as negative_with_why,
        cast(count(*) filter (label = 'negative' and explanation is null) as int) as negative_without_explanation
        from base b left join passages p using (id) group by b.id""",
    "check_evidence": f"""with {_PASSAGES} select id, evidence as chunk_id, count(*) as citations
        from passages where evidence = 'c8' group by id, evidence""",
    "check_error_envelope": f"""with {_CHOICES} select 'passages:' || cast(id as varchar) as request_id, choice_index,
        case when id % 26 = 0 then 'OUT_OF_IDEAS' else 'COULD_NOT_GENERATE_N_NEGATIVES' end as error, 'too short' as reason,
        cast(id % 5 as int) as produced_negatives, id % 26 <> 0 as known_error
        from choices where reason = 'error_envelope'""",
    "check_answer_leak": f"""with {_BASE}, said as (
          select id, {_normalised("text")} as answer, {_normalised("instruction")} as said from base
        ), worded as (
          select id, answer, said, string_split(answer, ' ') as aw, string_split(said, ' ') as sw from said
        ), words as (
          select id, 'a' as side, unnest(aw) as w, generate_subscripts(aw, 1) as i from worded
          union all select id, 's', unnest(sw), generate_subscripts(sw, 1) from worded
        ), grams as (
          select distinct id, side, gram from (
            select id, side, w || ' ' || lead(w) over t || ' ' || lead(w, 2) over t as gram
            from words window t as (partition by id, side order by i))
          where gram is not null
        ), shares as (
          select a.id, count(s.id) / count(*) as share from grams a
          left join grams s on s.id = a.id and s.gram = a.gram and s.side = 's' where a.side = 'a' group by a.id
        ), measured as (
          select w.id, answer <> '' and contains(' ' || said || ' ', ' ' || answer || ' ') as verbatim, round(coalesce(share, 0.0), 6) as overlap
          from worded w left join shares on shares.id = w.id
        ) select *, verbatim or overlap >= 0.5 as leaks from measured""",
    "check_variant_echo": f"""with {_INSTRUCTED}, echoed as (
          select id, style, length, case when id % 10 = 3 then 'other' when id % 10 <> 6 then style end as echo_style,
            case when id % 15 = 4 then 'other' else length end as echo_length
          from instruction_fate where reason is null
        ) select id, style, echo_style, echo_style = style as style_ok, length, echo_length,
          echo_length = length as length_ok from echoed""",
    "check_doc_partition": """select 'instruction:' || cast(doc_id as varchar) as request_id,
        doc_id % 6 = 1 or doc_id % 14 <> 2 as has_lists, doc_id % 8 <> 3 as has_relevant,
        case when doc_id % 6 = 1 then doc_id % 8 = 3 else doc_id % 14 <> 2 end as disjoint from documents""",
    "rule_violations": f"""with {_PASSAGES}, counted as (
          select label, len(regexp_extract_all(passage, '\\S+')) as words from passages
        ) select 'word_length' as rule,
          count(*) filter ((label = 'positive' and words not between 80 and 150)
            or (label = 'negative' and words not between 60 and 140)) as violations,
          count(*) filter (label in ('positive', 'negative')) as checked from counted""",
    "yield_audit": f"""with {_REJECTED}, kept as (
          select distinct id from choices where reason is null and id in (select id from ready)
            and id not in (select id from broken)
        ), lost as (
          select id, min(reason) filter (reason <> 'row_lost') as reason from rejected group by id
        ) select case when k.id is not null then 'packaged' else coalesce(l.reason, 'unknown') end as outcome,
          count(*) as inputs
        from documents d left join kept k on k.id = d.doc_id left join lost l on l.id = cast(d.doc_id as varchar)
        group by 1""",
    "variant_coverage": f"""with {_BASE}, varied as (
          select {_STYLE} as style, {_LENGTH} as length from base
        ), cells as (
          select style, length from unnest({_list([*STYLES, "all"])}) as s(style), unnest({_list([*LENGTHS, "all"])}) as l(length)
        ) select style, length, (
          select count(*) from varied v
          where (c.style = 'all' or v.style = c.style) and (c.length = 'all' or v.length = c.length)) as n
        from cells c""",
    "failure_mode_coverage": f"""with {_PASSAGES} select neg_type, count(*) as passages,
        round(avg(confidence), 6) as mean_confidence from passages where label = 'negative' group by neg_type""",
    "dataset_counts": f"""with {_PASSAGES} select (select count(*) from base) as entries,
        (select count(*) from base) as packages, count(*) as passages,
        count(*) filter (label_class = 'positive') as positives,
        count(*) filter (label_class = 'negative') as negatives from scored""",
    "training_pairs": f"""with {_PASSAGES}, ranked as (
          select *, row_number() over (partition by id, label order by pos) - 1 as k,
            count(*) over (partition by id, label) as n
          from passages where label in ('positive', 'negative')
        ), p as (select * from ranked where label = 'positive'), n as (select * from ranked where label = 'negative'),
        turns as (
          select distinct p.id, p.n as np, n.n as nn, unnest(range(greatest(p.n, n.n))) as row
          from p join n using (id) where p.k = 0 and n.k = 0
        ) select t.id, cast(t.row as int) as row, p.query || ' ' || p.instruction as query,
          p.passage as positive, n.passage as negative, n.neg_type
        from turns t join p on p.id = t.id and p.k = t.row % t.np join n on n.id = t.id and n.k = t.row % t.nn""",
    "filtered_passages": f"""with {_ROUTED} select id as original_id, query, instruction, item_id as passage_id, title,
        passage, label, 'kept' as filter_status, neg_type, explanation, cast(confidence as double) as confidence
        from routed where bucket like 'valid%'""",
}

ORACLE["write_filtered"] = ORACLE["filtered_passages"]

# The word-counting scorer, in SQL.
_WORDS = f"""pairs as ({ORACLE["relevance_pairs"].replace(f"with {_PASSAGES} ", "")}), counted as (
  select id, pos, kind, len(list_distinct(string_split(text, ' '))) / 8 as true_logit,
    len(string_split(text, ' ')) / 16 as false_logit from pairs
)"""
ORACLE["score_pairs"] = f"with {_PASSAGES}, {_WORDS} select id, pos, kind, true_logit, false_logit from counted"
ORACLE["route_scored"] = f"""with {_PASSAGES}, {_WORDS}, v as (
  select id, pos, bool_or(true_logit > false_logit) filter (kind = 'query') as q,
    bool_or(true_logit > false_logit) filter (kind = 'instruction') as i from counted group by id, pos
) select p.id, p.pos, case when label = 'positive' and q and i then 'valid_positive'
    when label = 'positive' then 'discarded_positive'
    when q and not i then 'valid_negative' else 'discarded_negative' end as bucket
  from passages p join v using (id, pos) where label in ('positive', 'negative')"""

ORACLE["score_string_ids"] = ORACLE["route_scored"].replace("select p.id,", "select 'a' || cast(p.id as varchar) as id,")


def _label_stats_of(tables: str, scores: str) -> str:
    """Label statistics of other scores than the passages' own."""
    rest = ORACLE["label_confidence_stats"].split("), grouped as (", 1)[1].replace("from scored", "from other")
    return f"with {tables}, other as ({scores}), grouped as ({rest}"


ORACLE["analyse_csv"] = _label_stats_of(_TEXT, """
  select case when label = 'positive' then 'positive' else 'negative' end as label_class, cast(confidence as double) as x
  from passages p join fate f using (id) where f.sound and not (p.id % 7 = 1)""")
ORACLE["verdict_score_stats"] = _label_stats_of(_PASSAGES, """
  select case when label = 'positive' then 'positive' else 'negative' end as label_class,
    len(list_distinct(w)) / cast(len(w) as double) - len(w) / cast(100003 as double) as x
  from (select label, string_split(passage, ' ') as w from passages)""")
ORACLE["csv_rejects"] = f"""with {_QA}, lines as (
  select id, case when id % 10 = 3 then cast(id as varchar) || ',q,a,more'
                  when id % 10 = 4 then cast(id as varchar) || ',q' end as bad
  from qa where id % 2 = 0 or id % 10 = 3
) select case when bad is null then 'good' else 'bad_record' end as kind, cast(id as varchar) as id, coalesce(bad, 'a') as text from lines
  union all select 'good', cast(id as varchar), 'a' from qa where id % 2 = 1"""
ORACLE["training_unpaired"] = f"""with {_PASSAGES}, per as (
  select b.id, count(*) filter (label = 'positive') as p, count(*) filter (label = 'negative') as n
  from base b left join passages using (id) group by b.id
) select id, 'unpaired' as reason, p > 0 as has_positive, n > 0 as has_negative from per where p = 0 or n = 0"""
ORACLE["append_batches"] = ORACLE["append_packages"]
ORACLE["stream_requests_once"] = ORACLE["stream_requests"]
ORACLE["label_stats_increments"] = f"""select label_class, count, mean, std, min, max, variance, skewness, kurtosis, percentage
  from ({ORACLE["label_confidence_stats"]})"""
