r"""Chat formatting by a grammar round trip, in DataFrame functions only.

A formatted conversation is a row of turns ``### <role>: <text>\n</turn>\n``. The parser is deterministic: it cuts at
every ``</turn>\n`` that has no backslash before it, reads the role up to the first colon, and takes one backslash
from each run of them that leads to a control string (``### `` or ``</turn>``). A turn whose text holds a control
string without a backslash does not parse. Roles write ``%``, ``:``, ``#`` and ``<`` as percent codes.

Each turn is first rendered as it stands, parsed again and compared with its source; where the two differ its content
is escaped one level further, until they are identical. Whole conversations are put together from such turns, parsed
once more, and held against hashes of the source's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named

#: Fixed strings of the template.
HEAD, SEP, END = "### ", ": ", "</turn>\n"
#: A control string, and one that no backslash precedes.
CONTROL, BARE = r"(?:### |</turn>)", r"(?<!\\)(?:### |</turn>)"
#: Characters of a role that are written as codes; the percent sign is the first to be written, the last to be read.
CODES = [("%", "%25"), (":", "%3A"), ("#", "%23"), ("<", "%3C")]
#: Levels of escaping: as it stands, then one backslash more before every control string and codes in the role.
LEVELS = 2


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*{CONTROL})", r"\\$1")


def unescape_text(body: Column) -> Column:
    return F.regexp_replace(body, rf"\\(\\*{CONTROL})", "$1")


def escape_role(role: Column) -> Column:
    for char, code in CODES:
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for char, code in reversed(CODES):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def render(role: Column, text: Column, level: int) -> Column:
    """One turn, escaped so far."""
    role, text = (escape_role(role), escape_text(text)) if level else (role, text)
    return F.concat(F.lit(HEAD), role, F.lit(SEP), text, F.lit("\n" + END))


def parse(formatted: Column) -> Column:
    """Array of (role, text, head, body) of formatted text: ``head`` and ``body`` are characters before the text and of it as
    it is written. A piece that is no turn, or an unfinished one, is a null; so is the array of a null."""
    pieces = F.split(formatted, r"(?<!\\)" + END, -1)

    def turn(piece: Column) -> Column:
        code = F.substring_index(F.substr(piece, F.lit(len(HEAD) + 1)), SEP, 1)
        head = F.char_length(code) + F.lit(len(HEAD) + len(SEP))
        size = F.char_length(piece) - head - F.lit(1)
        body = F.substr(piece, head + 1, size)
        legal = F.startswith(piece, F.lit(HEAD)) & F.endswith(piece, F.lit("\n")) & (size >= 0) & ~code.rlike("[:#<]") & ~body.rlike(BARE)
        legal = legal & (F.substr(piece, head - F.lit(len(SEP) - 1), F.lit(len(SEP))) == SEP)
        return F.when(legal, F.struct(unescape_role(code).alias("role"), unescape_text(body).alias("text"), head.alias("head"), size.alias("body")))

    whole = F.when(F.element_at(pieces, -1) == "", F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)
    return F.transform(whole, turn)


def _settled(role: Column, text: Column) -> Column:
    """The turn as first rendered so that it parses to itself and nothing else."""
    out = F.raise_error(F.lit("a turn is not read back as it was written"))
    for level in reversed(range(LEVELS)):
        written = render(role, text, level)
        back = parse(written)
        same = (F.size(back) == 1) & (back[0]["role"] == role) & (back[0]["text"] == text)
        out = F.when(F.coalesce(same, F.lit(False)), written).otherwise(out)
    return out


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and stop, in code points of ``formatted``, of each text
    whose role is ``learn``, as it is written), source_hashes (of each turn's role and text).

    Rows go by turn, nulls first; rows of one turn by role, then text. Null roles and texts are empty ones; rows without
    a conversation are one conversation, with a null id; rows that repeat are turns of their own. An empty table gives no
    rows. Texts are whole at any length, a formatted conversation being one value (2 GB at most, as of any column). Other
    columns are not read.
    """
    text, role = F.coalesce(named(text_col), F.lit("")), F.coalesce(named(role_col), F.lit(""))
    turns = rows.select(named(conv_col).alias("conv_id"), named(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    turns = turns.withColumn("written", _settled(F.col("role"), F.col("text")))
    size, head = F.char_length("written"), F.char_length(escaped_head("role", "written"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    # the place, then the start of each turn, over rows that the grouping below takes from the same partition
    turns = turns.select("conv_id", "role", "written", F.xxhash64("role", "text").alias("hash"), head.cast("long").alias("head"), size.cast("long").alias("size"), F.row_number().over(order).alias("place"), (F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size).alias("start"))
    start = F.col("start") + F.col("head")
    span = F.when(F.col("role") == learn, F.struct(start.alias("start"), (F.col("start") + F.col("size") - F.lit(len(END) + 1)).alias("stop")))
    parts = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "written", "hash", span.alias("span")))).alias("parts"))
    return parts.select(
        "conv_id", F.array_join(F.col("parts.written"), "").alias("formatted"), F.filter("parts.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.col("parts.hash").alias("source_hashes")
    )


def escaped_head(role_col: str, written_col: str) -> Column:
    """What stands before a written turn's text; the role may or may not have needed codes."""
    coded = F.concat(F.lit(HEAD), escape_role(F.col(role_col)), F.lit(SEP))
    return F.when(F.startswith(written_col, coded), coded).otherwise(F.concat(F.lit(HEAD), F.col(role_col), F.lit(SEP)))


def read_back(chats: DataFrame, learn: str = "assistant") -> DataFrame:
    """Rows of :func:`format_chats` with what their text parses to: ``turns`` (role, text) and ``loss`` (texts under the mask).

    Raises an error where turns differ from the source's, or the mask's spans from the places of the texts read.
    """
    back = chats.withColumn("turns", parse(F.col("formatted")))
    same = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])) == F.col("source_hashes")
    learned = F.filter("turns", lambda t: t["role"] == learn)
    widths = F.transform("loss_spans", lambda s: (s["stop"] - s["start"]).cast("int")) == F.transform(learned, lambda t: t["body"])
    checked = F.when(same & widths, F.col("turns")).otherwise(F.raise_error(F.lit("a conversation is not read back as it was written")))
    back = back.withColumn("turns", checked)
    return back.withColumn("loss", F.transform(F.filter("turns", lambda t: t["role"] == learn), lambda t: t["text"]))


def op13_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations, and one (-7) that holds control strings, with digests of what is read back from the output."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], rows.schema)
    back = read_back(format_chats(rows.unionByName(more)))
    loss = F.array_join("loss", "")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars")
    )


OP13_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
     w AS (SELECT *, '### ' || replace(replace(replace(replace(role, '%', '%25'), ':', '%3A'), '#', '%23'), '<', '%3C') || ': ' || regexp_replace(text, '(\\*(?:### |</turn>))', '\\\1', 'g') || chr(10) || '</turn>' || chr(10) AS written FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(written)) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""
