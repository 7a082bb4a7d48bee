"""Messages and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.functions import text as tx
from docketry.operators import converse
from docketry.plans.registry import query, sql_trim, table, texts


def messages(spark, sf):
    return table(spark, sf, "conversations")


def long_talks(spark, sf):
    """Events of a user as one long conversation: more than the last thirty count."""
    role = F.when(F.col("event_type") == "error", "system").when(F.col("event_type") == "view", "assistant").otherwise("user")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("conv_id"),
        F.col("event_id").alias("turn"),
        role.alias("role"),
        F.concat("event_type", F.lit(" "), F.col("value").cast("string")).alias("text"),
    )


SQL_TALKS = """
talks as (select user_id as conv_id, event_id as turn, case event_type when 'error' then 'system' when 'view' then 'assistant' else 'user' end as role,
  event_type || ' ' || value as text from events),
recent as (select * from (select *, row_number() over (partition by conv_id order by turn desc) as rn from talks) where rn <= 30)
"""


@query(f"with {SQL_TALKS} select conv_id, turn from recent")
def recent_messages(spark, sf):
    return converse.last_messages(long_talks(spark, sf)).select("conv_id", "turn")


@query(f"""
with {SQL_TALKS} select conv_id, string_agg(upper(role[1]) || role[2:] || ': ' || text, chr(10) order by turn) as history
from recent where role <> 'system' group by 1
""")
def history_lines(spark, sf):
    return converse.history_text(long_talks(spark, sf))


@query("""
select conv_id, string_agg(text, '. ' order by turn) as text from conversations where role = 'user' group by 1
""")
def combined_queries(spark, sf):
    return converse.combined_query(messages(spark, sf))


@query("""
select conv_id, string_agg(text, '. ' order by turn) as text from (
  select *, row_number() over (partition by conv_id order by turn desc) as rn from conversations where role = 'user') where rn <= 2 group by 1
""")
def combined_with_last(spark, sf):
    return converse.combined_query(messages(spark, sf), last_n=1)


SQL_ESCAPED = "replace(replace(text, '{', '{{'), '}', '}}')"


@query(f"""
select conv_id, {SQL_ESCAPED} as query from (select conv_id, arg_max('{{"q": "' || text || '"}}', turn) as text from conversations where role = 'user' group by 1)
""")
def request_query(spark, sf):
    braced = messages(spark, sf).withColumn("text", F.concat(F.lit('{"q": "'), "text", F.lit('"}')))
    return converse.split_request(braced)["query"]


@query("""
with m as (select conv_id, turn, role, case when turn = 3 then '  ' else text end as text from conversations),
q as (select conv_id, max(turn) as asked from m where role = 'user' group by 1)
select conv_id, turn, role, replace(replace(text, '{', '{{'), '}', '}}') as text from m left join q using (conv_id)
where (asked is null or turn <> asked) and not (role = 'assistant' and trim(text) = '')
""")
def request_history(spark, sf):
    blanked = messages(spark, sf).withColumn("text", F.when(F.col("turn") == 3, "  ").otherwise(F.col("text")))
    return converse.split_request(blanked)["history"]


@query("""
select conv_id, 'Answer briefly.' || coalesce(' ' || string_agg(text, ' ' order by turn) filter (role = 'system'), '') as prompt
from conversations group by 1
""")
def system_prompts(spark, sf):
    return converse.system_prompt(messages(spark, sf), "Answer briefly.")


@query(f"""
with {SQL_TALKS} select conv_id, 'Answer briefly.' || coalesce(' ' || string_agg(text, ' ' order by turn) filter (role = 'system'), '') as prompt
from talks group by 1
""")
def system_prompts_of_long_talks(spark, sf):
    """Turns of many thousands, so the order column is no count of messages."""
    return converse.system_prompt(long_talks(spark, sf), "Answer briefly.")


def _parts(spark, sf):
    """Messages as multipart content: text, a picture in answers, and the role."""
    part = "named_struct('type', '{}', 'text', {}, 'url', {})".format
    return messages(spark, sf).select(
        "conv_id",
        "turn",
        F.expr(
            f"case when role = 'assistant' then array({part('text', 'text', 'cast(null as string)')}, "
            f"{part('image_url', 'cast(null as string)', 'concat(' + repr('pic-') + ', turn)')}, {part('text', 'role', 'cast(null as string)')}) "
            f"else array({part('text', 'text', 'cast(null as string)')}, {part('text', 'role', 'cast(null as string)')}) end"
        ).alias("parts"),
    )


@query(f"""
select conv_id, turn, text || ' ' || role as text_only,
  concat_ws(chr(10) || chr(10), nullif({sql_trim('text')}, ''), case when role = 'assistant' then 'pic-' || turn end, role) as query_text,
  role = 'assistant' as pictured from conversations
""")
def multipart_content(spark, sf):
    parts = F.col("parts")
    return _parts(spark, sf).select(
        "conv_id",
        "turn",
        converse.content_text(parts).alias("text_only"),
        converse.content_query(parts).alias("query_text"),
        converse.has_image(parts).alias("pictured"),
    )


@query("""
select q.conv_id,
  string_agg('Question: ' || q.text || chr(10) || 'Answer: ' || a.text, chr(10) || chr(10) || chr(10) order by q.turn) as text
from conversations q join conversations a on a.conv_id = q.conv_id and a.turn = q.turn + 1
where q.role = 'user' and a.role = 'assistant' group by 1
""")
def question_answer_texts(spark, sf):
    return converse.question_answer_text(converse.question_answer_pairs(messages(spark, sf)))


# ---------------------------------------------------------------- text functions


@query("""
select conv_id, turn, case when role = 'user' then 'a' || text else '' end as text from conversations
""")
def think_removed(spark, sf):
    """Closed spans go; an unclosed one takes the rest with it."""
    closed = F.concat(F.lit("<think>x\ny</think>a"), "text", F.lit("<think></think>"))
    wrapped = F.when(F.col("role") == "user", closed).otherwise(F.concat(F.lit("<think>"), "text"))
    return messages(spark, sf).select("conv_id", "turn", tx.strip_think(wrapped).alias("text"))


@query(rf"""
select doc_id, {sql_trim(r"regexp_replace(text, '\n\s*\n', chr(10), 'g')")} as text from documents
""")
def blank_lines_collapsed(spark, sf):
    return texts(spark, sf).select("doc_id", tx.collapse_blank_lines(F.col("text")).alias("text"))


@query(rf"""
select conv_id, turn, case when turn = 0 or turn = 1 or turn = 2 then null else {sql_trim(r"regexp_replace(text, '\n\s*\n', chr(10), 'g')")} end as reply
from conversations
""")
def filter_replies(spark, sf):
    reply = (
        F.when(F.col("turn") == 0, F.concat(F.lit(" no_filter: "), "text"))
        .when(F.col("turn") == 1, F.concat(F.lit("<think>hm</think>\nUnsupported "), "text"))
        .when(F.col("turn") == 2, F.concat(F.lit("<think>"), "text"))
        .otherwise(F.concat(F.lit("<think>hm</think>\n\n"), "text"))
    )
    return messages(spark, sf).select("conv_id", "turn", tx.filter_reply(reply).alias("reply"))


@query(rf"""
with l as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[0-9]')) as ls from documents),
i as (select doc_id, generate_subscripts(ls, 1)::int - 1 as pos, {sql_trim('unnest(ls)')} as line from l)
select doc_id, pos, case when contains(line, '. ') then line[strpos(line, '. ') + 2:] else line end as item from i
""")
def numbered_lines(spark, sf):
    return texts(spark, sf).select("doc_id", F.posexplode(tx.numbered_items(F.col("text"))).alias("pos", "item"))


@query(f"""
select conv_id, turn, nullif(replace(replace({sql_trim("case when turn = 2 then ' ' || chr(34) || chr(34) else chr(39) || text || chr(34) end")}, chr(39), ''), chr(34), ''), '') as question
from conversations
""")
def follow_up_questions(spark, sf):
    raw = F.when(F.col("turn") == 2, ' ""').otherwise(F.concat(F.lit("'"), "text", F.lit('"')))
    return messages(spark, sf).select("conv_id", "turn", tx.follow_up(raw).alias("question"))


@query(f"select event_id, {SQL_ESCAPED.replace('text', 'props')} as props from events")
def escaped_braces(spark, sf):
    return table(spark, sf, "events").select("event_id", tx.escape_braces(F.col("props")).alias("props"))


@query("select page_id, regexp_replace(html, '(?s)<!--.*?-->|<[^>]*>', '', 'g') as text from pages")
def html_stripped(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.strip_html(F.col("html")).alias("text"))


@query("select conv_id, turn, case when turn <> 5 then role end as role from conversations")
def role_names(spark, sf):
    raw = F.when(F.col("turn") == 5, F.concat("role", F.lit("s"))).otherwise(F.concat(F.lit("<b>"), F.upper("role"), F.lit("</b>")))
    return messages(spark, sf).select("conv_id", "turn", tx.role_name(raw).alias("role"))


@query("select doc_id, case when length(text) > 500 then text[:500] || '... [content truncated]' else text end as shown from documents")
def previews(spark, sf):
    return texts(spark, sf).select("doc_id", tx.preview(F.col("text")).alias("shown"))
