"""Chat formatting with a grammar round trip, DataFrame functions only.

The grammar:

    conversation := "<s>" turn*
    turn         := "[INST] " text " [/INST]"                  (role user)
                  | "[ASST] " text "</s>"                      (role assistant)
                  | "[ROLE] " role "[TEXT] " text "[/ROLE]"    (any other role)

The parser is deterministic: it cuts after every closing mark and accepts a cut
as a turn only if no control string is left inside. A turn is rendered, parsed
back and compared with its source; where they differ its content is escaped (a
backslash goes into each string that looks like a control string, escaped ones
included) and the turn is parsed and compared again. A conversation's rendered
text is then parsed as a whole and compared with all its turns; a difference
ends the job with an error, so no text leaves here that does not read back.

Turns are ordered by turn (null first), then role, then text; repeated rows are
repeated turns. Null roles and texts count as empty. Rows with a null conv_id
form one conversation. A conversation has to fit in one row, as its text does.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN = "<s>"
#: Opening and closing marks by role.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("[ASST] ", "</s>")}
OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE = "[ROLE] ", "[TEXT] ", "[/ROLE]"
#: Control strings, and what escaping touches: the same with any backslashes.
CONTROL = r"\[/?(?:INST|ASST|ROLE|TEXT)\]|</?s>"
SQUARE, ANGLE = r"\[(\\*)(/?(?:INST|ASST|ROLE|TEXT)\])", r"<(\\*)(/?s>)"
SQUARE_ESCAPED, ANGLE_ESCAPED = r"\[\\(\\*)(/?(?:INST|ASST|ROLE|TEXT)\])", r"<\\(\\*)(/?s>)"
AFTER_CLOSE = r"(?<=\[/INST\]|</s>|\[/ROLE\])"


def escape(text: Column) -> Column:
    once = F.regexp_replace(text, SQUARE, r"[\\$1$2")
    return F.regexp_replace(once, ANGLE, r"<\\$1$2")


def unescape(text: Column) -> Column:
    once = F.regexp_replace(text, SQUARE_ESCAPED, r"[$1$2")
    return F.regexp_replace(once, ANGLE_ESCAPED, r"<$1$2")


def opening(role: Column) -> Column:
    other = F.concat(F.lit(OTHER_OPEN), role, F.lit(OTHER_TEXT))
    for name, (mark, _) in MARKS.items():
        other = F.when(role == name, F.lit(mark)).otherwise(other)
    return other


def closing(role: Column) -> Column:
    other = F.lit(OTHER_CLOSE)
    for name, (_, mark) in MARKS.items():
        other = F.when(role == name, F.lit(mark)).otherwise(other)
    return other


def turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def inside(cut: Column, before: Column, after: str) -> Column:
    """``cut`` without ``before`` characters in front and the mark ``after`` behind."""
    return F.substring(cut, before + 1, F.length(cut) - before - len(after))


def parsed(cut: Column) -> Column:
    """The turn that a cut stands for; its role is null if it is none."""
    wrong = turn(F.lit(None).cast("string"), cut)
    at = F.position(F.lit(OTHER_TEXT), cut)
    role = F.substring(cut, F.lit(len(OTHER_OPEN) + 1), at - len(OTHER_OPEN) - 1)
    text = inside(cut, at + len(OTHER_TEXT) - 1, OTHER_CLOSE)
    whole = cut.startswith(OTHER_OPEN) & cut.endswith(OTHER_CLOSE) & (at > len(OTHER_OPEN))
    clear = ~role.rlike(CONTROL) & ~text.rlike(CONTROL) & ~unescape(role).isin(*MARKS)
    out = F.when(whole & clear, turn(unescape(role), unescape(text))).otherwise(wrong)
    for name, (first, last) in MARKS.items():
        text = inside(cut, F.lit(len(first)), last)
        good = (
            cut.startswith(first) & cut.endswith(last)
            & (F.length(cut) >= len(first) + len(last)) & ~text.rlike(CONTROL)
        )
        out = F.when(good, turn(F.lit(name), unescape(text))).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation (array of role, text)."""
    cuts = F.split(F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted)), AFTER_CLOSE)
    return F.transform(F.filter(cuts, lambda c: c != ""), parsed)


def rendered(turns: DataFrame) -> DataFrame:
    """Each turn with ``said`` (its text, escaped if need be) and ``cut`` (its rendering)."""

    def render(role: str, text: str) -> Column:
        return F.concat(opening(F.col(role)), F.col(text), closing(F.col(role)))

    def reads_back(cut: str) -> Column:
        alone = F.concat(F.lit(BEGIN), F.col(cut))
        return parse(alone) == F.array(turn(F.col("role"), F.col("text")))

    plain = turns.withColumn("plain", render("role", "text"))
    marked = plain.withColumn("same", F.coalesce(reads_back("plain"), F.lit(False)))
    # escaping leaves the roles that have marks of their own as they are
    escaped = marked.select(
        "*",
        F.when(F.col("same"), F.col("role")).otherwise(escape(F.col("role"))).alias("shown"),
        F.when(F.col("same"), F.col("text")).otherwise(escape(F.col("text"))).alias("said"),
    ).withColumn("cut", render("shown", "said"))
    wrong = F.raise_error(F.concat(F.lit("a turn does not read back: "), F.col("cut"))).cast("string")
    sure = F.when(F.col("same") | reads_back("cut"), F.col("cut")).otherwise(wrong)
    return escaped.withColumn("cut", sure).drop("plain", "same")


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss (array of start, length: the assistants' texts), turns."""
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.coalesce(
        F.sum(F.length("cut").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    said = MARKS["assistant"][0]
    placed = rendered(turns).select(
        "conv_id",
        F.struct(
            F.row_number().over(order).alias("place"),
            "role",
            "text",
            "cut",
            (before + len(BEGIN) + len(said)).alias("start"),
            F.length("said").cast("long").alias("length"),
        ).alias("t"),
    )
    whole = (
        placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select(
            "conv_id",
            F.concat(F.lit(BEGIN), F.array_join("t.cut", "")).alias("formatted"),
            F.transform(
                F.filter("t", lambda t: t["role"] == "assistant"),
                lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
            ).alias("loss"),
            F.transform("t", lambda t: turn(t["role"], t["text"])).alias("turns"),
        )
    )
    same = F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("a conversation does not read back: "), F.col("formatted")))
    return whole.withColumn(
        "formatted", F.when(same, F.col("formatted")).otherwise(wrong.cast("string"))
    )


def loss_texts(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(
        loss,
        lambda s: unescape(
            F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
        ),
    )
