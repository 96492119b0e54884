"""Chat formatting: collected turns sorted, merged and concatenated by Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """No control string begins in the result: each ``<``, backslashes, ``|`` gets one more backslash."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role stands on one line and holds no control string."""
    for plain, mark in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(mark))
    return role


def unescaped_role(role: Column) -> Column:
    for plain, mark in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(mark), F.lit(plain))
    return role


def chat_format(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = TRAINED_ROLE,
) -> DataFrame:
    """Per conversation: id, formatted, loss_runs.

    Turns go by (turn, role, text), null turns first; a null role or text is empty. Adjacent turns of
    one role share a block ``<|im_start|>role\\n text <|im_sep|> text <|im_end|>\\n`` (without the
    spaces). Texts and roles are escaped, so that control strings are the template's own and every turn
    can be read back (``read_back``). ``loss_runs`` cuts ``formatted`` from end to end into runs of
    (chars, loss), by turns a run of marks and a text; loss holds for texts of ``trained_role`` alone.
    Repeated rows are turns like others. Rows of a null id form one conversation. Other columns are
    left behind. A conversation is one example and so one cell; its turns meet in one task. No step
    over a conversation's turns is more than linear in them.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    sorted_turns = rows.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("sorted"))
    shown = F.transform(
        "sorted",
        lambda t, i: F.struct(
            t["role"].alias("role"),
            escaped(t["text"]).alias("text"),
            ((i == 0) | (t["role"] != F.get("sorted", F.greatest(i - 1, F.lit(0)))["role"])).alias("opens"),
        ),
    )
    turns = sorted_turns.select("id", shown.alias("turns"))
    places = F.sequence(F.lit(0), F.size("turns") - 1)
    heads = turns.select("id", "turns", F.filter(places, lambda i: F.get("turns", i)["opens"]).alias("heads"))

    def block(head: Column, k: Column) -> Column:
        after = F.coalesce(F.get("heads", k + 1), F.size("turns"))
        texts = F.transform(F.slice("turns", head + 1, after - head), lambda t: t["text"])
        role = escaped_role(F.get("turns", head)["role"])
        return F.concat(F.lit(START), role, F.lit("\n"), F.array_join(texts, SEP), F.lit(f"{END}\n"))

    run = lambda chars, loss: F.struct(chars.cast("long").alias("chars"), loss.alias("loss"))

    def runs(t: Column, i: Column) -> Column:
        opening = F.length(escaped_role(t["role"])) + len(START) + 1 + F.when(i > 0, len(END) + 1).otherwise(0)
        mark = F.when(t["opens"], opening).otherwise(len(SEP))
        return F.array(run(mark, F.lit(False)), run(F.length(t["text"]), t["role"] == trained_role))

    return heads.select(
        F.col("id").alias(id_col),
        F.array_join(F.transform("heads", block), "").alias("formatted"),
        F.concat(F.flatten(F.transform("turns", runs)), F.array(run(F.lit(len(END) + 1), F.lit(False)))).alias("loss_runs"),
    )


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation: id, formatted_chars, turns as array of (role, text, loss), unescaped, out of formatted and loss_runs.

    A run that does not fit the text it stands for is an error.
    """
    blocks = F.filter(F.split("formatted", rf"<\|im_end\|>\n"), lambda b: b != "")

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = unescaped_role(F.substr(head, F.lit(len(START) + 1)))
        body = F.substr(block, F.length(head) + 2)
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(role.alias("role"), t.alias("text")))

    found = formatted.select(
        F.col(id_col).alias("id"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.flatten(F.transform(blocks, turns)).alias("turns"),
        F.filter("loss_runs", lambda r, i: i % 2 == 1).alias("runs"),
        (F.aggregate("loss_runs", F.lit(0).cast("long"), lambda n, r: n + r["chars"]) == F.length("formatted")).alias("fits"),
    )
    misfit = F.raise_error(F.lit("loss runs do not fit the formatted text"))

    def turn(t: Column, i: Column) -> Column:
        own = F.get("runs", i)
        text = F.when(own["chars"] == F.length(t["text"]), unescaped(t["text"])).otherwise(misfit)
        return F.struct(t["role"].alias("role"), text.alias("text"), own["loss"].alias("loss"))

    whole = F.when(F.col("fits") & (F.size("runs") == F.size("turns")), F.col("turns")).otherwise(misfit)
    return found.select(F.col("id").alias(id_col), "formatted_chars", F.transform(whole, turn).alias("turns"))


def format_digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256 as read back, and formatted_chars."""
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read_back(formatted, id_col).select(
        id_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"), "formatted_chars",
    )
