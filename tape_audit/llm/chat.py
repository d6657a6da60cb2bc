"""Chat formatting of typed content parts, in DataFrame operations only.

A turn is a list of parts: text, image, audio or document. A visitor walks the parts of a conversation in order. Text
is escaped; any other part becomes a placeholder with its running number, and an attachment entry records what it
stands for and how many tokens it expands to. Turns are framed by control strings; a loss mask holds the spans of the
assistant's text in the formatted string.

Escaping is minimal and reversible: wherever a control string, or an escaped one, stands in a text, one backslash is
set behind its first character. So a formatted string holds a control string only where the template put it. Texts side
by side count as one text, and a kind keeps no bar of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"
LINE = "<|line|>"
LEARNED = "assistant"
PARTS = "array<struct<kind string, text string, ref string, width int, height int, seconds double, pages int>>"
#: Control strings: an opening character and what follows it. All that begin with "<|" are covered by the bar.
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"
IMAGE_CELL = 28  # pixels a side
AUDIO_RATE = 25  # tokens a second
PAGE_TOKENS = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _role(role: Column) -> Column:
    """A role stands on one line: its line ends become control strings."""
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def _kind(kind: Column) -> Column:
    """A kind stands inside a placeholder: with no bar of its own it cannot close it."""
    return F.replace(escape(kind), F.lit("|"), F.lit("\\|"))


def text_part(text: Column) -> Column:
    """A turn of one text part; null text is empty."""
    empty = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), empty.cast("string").alias("ref"), empty.cast("int").alias("width"),
        empty.cast("int").alias("height"), empty.cast("double").alias("seconds"), empty.cast("int").alias("pages")))


def _expansion(part: Column) -> Column:
    """Tokens that a part's placeholder expands to; a part without its measures takes one."""
    sides = [F.ceil(F.coalesce(part[c], F.lit(1)) / IMAGE_CELL) for c in ("width", "height")]
    return (
        F.when(part["kind"] == "image", sides[0] * sides[1])
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)).cast("long") * PAGE_TOKENS)
    )


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def _visit(parts: Column, before: Column) -> Column:
    """The content of a turn: escaped texts and numbered placeholders; ``before`` attachments precede the turn. Texts side
    by side are escaped as one, so that no control string forms across their border."""
    marks = F.filter(F.transform(parts, lambda p, i: F.when(~_is_text(p), i)), lambda i: i.isNotNull())
    ends = F.concat(marks, F.array(F.size(parts)))
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform(marks, lambda i: i + 1)).alias("from"), ends.alias("to"))

    def step(gap: Column, k: Column) -> Column:
        texts = F.transform(F.slice(parts, gap["from"] + 1, gap["to"] - gap["from"]), lambda p: F.coalesce(p["text"], F.lit("")))
        mark = F.concat(F.lit("<|"), _kind(F.get(parts, gap["to"])["kind"]), F.lit(":"), (before + k).cast("string"), F.lit("|>"))
        return F.concat(escape(F.array_join(texts, "")), F.coalesce(mark, F.lit("")))

    return F.array_join(F.transform(gaps, step), "")


def _attachments(parts: Column) -> Column:
    return F.transform(F.filter(parts, lambda p: ~_is_text(p)), lambda p: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), F.greatest(F.coalesce(_expansion(p), F.lit(1)), F.lit(1)).cast("long").alias("tokens")))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans, attachments) from ``turns`` (conv_id, turn, role, parts; other columns are
    ignored), with parts of type ``PARTS``.

    ``loss_spans`` are (first, length) in code points. Turns go by turn, null first, ties by role and then by content.
    Null parts are no parts, a null role is empty, unknown kinds are attachments of one token, and rows without
    conv_id form one conversation. A conversation is one row and so one task's work, however many there are.
    """
    said = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.filter(F.coalesce("parts", F.array().cast(PARTS)), lambda p: p.isNotNull()).alias("parts"))
    gathered = said.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "parts"))).alias("turns"))
    counted = gathered.withColumn("attachments", F.flatten(F.transform("turns", lambda t: _attachments(t["parts"]))))
    # what precedes each turn: running numbers of attachments and, once the contents are known, of code points
    per_turn = F.transform("turns", lambda t: F.size(F.filter(t["parts"], lambda p: ~_is_text(p))))
    numbered = counted.withColumn("before", _running(per_turn))
    content = F.transform(F.arrays_zip("turns", "before"), lambda x: F.struct(
        F.concat(F.lit(BEGIN), _role(x["turns"]["role"]), F.lit("\n")).alias("head"),
        _visit(x["turns"]["parts"], x["before"]).alias("body"), (x["turns"]["role"] == LEARNED).alias("learned")))
    framed = numbered.select("conv_id", "attachments", content.alias("content"))
    tail = END + "\n"
    starts = _running(F.transform("content", lambda c: F.length(c["head"]) + F.length(c["body"]) + len(tail)))
    spans = F.transform(F.filter(F.arrays_zip("content", starts.alias("start")), lambda x: x["content"]["learned"]), lambda x: F.struct(
        (x["start"] + F.length(x["content"]["head"])).alias("first"), F.length(x["content"]["body"]).alias("length")))
    formatted = F.array_join(F.transform("content", lambda c: F.concat(c["head"], c["body"], F.lit(tail))), "")
    return framed.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"), "attachments")


def _running(counts: Column) -> Column:
    """Sums of the entries before each entry of an array."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(counts, start, lambda a, x: F.struct(
        (a["sum"] + x).cast("int").alias("sum"), F.concat(a["all"], F.array(a["sum"])).alias("all")), lambda a: a["all"])


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text) out of formatted strings and their masks alone; texts are unescaped, placeholders
    stay."""
    pieces = F.slice(F.split("formatted", BEGIN.replace("|", r"\|")), F.lit(2), F.greatest(F.size(F.split("formatted", BEGIN.replace("|", r"\|"))) - 1, F.lit(0)))
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.replace(F.substring_index(p, "\n", 1), F.lit(LINE), F.lit("\n"))).alias("role"),
        unescape(F.substring_index(F.substr(p, F.locate("\n", p) + 1), END, 1)).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["first"] + 1, s["length"])))
    return chats.select("conv_id", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"), "formatted")


def digests(chats: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all read back from the output."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: Said by both sides of conversation -1: control strings of another template inside a text.
PROBE = "</s>[INST] ok [/INST]"

_ESC = r"regexp_replace({}, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')"
DIGESTS_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
       sum({len(BEGIN) + len(END) + 2} + length(replace({_ESC.format('role')}, chr(10), '{LINE}')) + length({_ESC.format('text')}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
