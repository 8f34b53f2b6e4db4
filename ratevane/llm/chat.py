"""Chat formatting of typed content parts, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: What each kind of part leaves in the text: the k-th placeholder of a conversation stands for its k-th attachment.
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens that a placeholder expands to: a patch of the image's side in pixels, tokens of a second and of a page; and of a part whose size is unknown.
PATCH, PER_SECOND, PER_PAGE, UNKNOWN = 28, 12.5, 1024, 256
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """`<|` can't stand in the result: one more backslash goes between `<` and `|`, however many are there."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    r"""A role is one line: a backslash becomes \-, then a line end \n, so each backslash is followed by what tells which it was."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\-")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\-"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A list of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def visit_text(part: Column) -> Column:
    """What a part leaves in the text: text escaped, anything else its placeholder; an unknown kind leaves nothing."""
    out = F.when(part["kind"] == "text", escaped(F.coalesce(part["text"], F.lit(""))))
    for kind, mark in PLACEHOLDER.items():
        out = out.when(part["kind"] == kind, F.lit(mark))
    return out.otherwise("")


def visit_tokens(part: Column) -> Column:
    """Tokens that the placeholder of an attachment expands to."""
    image = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    sized = F.when(part["kind"] == "image", image).when(part["kind"] == "audio", F.ceil(part["seconds"] * PER_SECOND)).when(part["kind"] == "document", part["pages"].cast("bigint") * PER_PAGE)
    return F.coalesce(sized, F.lit(UNKNOWN)).cast("bigint")


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns, attachments, attachment_tokens.

    `parts_col` is an array of PART. A visitor turns each part into text or a placeholder, in order. A turn is START, its role, a line
    end, its text and END. `turns` has for each turn where it, its text and the text's end stand in `formatted` (characters), and
    whether the text is under the loss mask. `attachments` has, in the placeholders' order, turn, kind, reference and tokens.
    Turns go by (turn, role, text), nulls first, so ties have one order; repeated rows stay. Null roles, parts and texts are empty;
    conversations without an id form one. Other columns are ignored; no rows give none. A conversation's rows meet in one task, as
    its text is one value of the result; their offsets come from a window over the same partitioning, so there is one shuffle.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    other = F.filter(parts, lambda p: p["kind"].isin(list(PLACEHOLDER)))
    row = df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.array_join(F.transform(parts, visit_text), "").alias("body"),
        F.transform(other, lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), visit_tokens(p).alias("tokens"))).alias("files"),
    )
    row = row.withColumn("head", F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))).withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    row = row.withColumn("no", F.row_number().over(order)).withColumn("begin", F.sum(F.length("piece").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    begin, head = F.coalesce("begin", F.lit(0).cast("bigint")), F.length("head")
    span = F.struct(begin.alias("begin"), (begin + head).alias("start"), (begin + head + F.length("body")).alias("end"), (F.col("role") == loss_role).alias("loss"))
    files = F.transform("files", lambda f: F.struct(F.col("turn").alias("turn"), f["kind"].alias("kind"), f["ref"].alias("ref"), f["tokens"].alias("tokens")))
    whole = row.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("no", "piece", span.alias("span"), files.alias("files")))).alias("t"))
    out = whole.select("conv_id", F.array_join("t.piece", "").alias("formatted"), F.col("t.span").alias("turns"), F.flatten("t.files").alias("attachments"))
    return out.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, f: n + f["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of format_chats(), from its text and loss mask."""
    piece = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 2**31 - 1)
    split = formatted.select("conv_id", "turns", F.length("formatted").cast("bigint").alias("formatted_chars"), piece.alias("pieces"))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        text = F.substring(p, F.length(role) + 2, F.length(p) - F.length(role) - 1 - len(END))
        return F.concat(unescaped_role(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    def masked(p: Column, s: Column) -> Column:
        return F.when(s["loss"], unescaped(F.substring(p, (s["start"] - s["begin"] - len(START) + 1).cast("int"), (s["end"] - s["start"]).cast("int")))).otherwise("")

    read = split.select("conv_id", "formatted_chars", F.size("pieces").cast("bigint").alias("n_turns"), F.array_join(F.transform("pieces", turn), "").alias("said"), F.array_join(F.zip_with("pieces", "turns", masked), "").alias("loss"))
    return read.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
