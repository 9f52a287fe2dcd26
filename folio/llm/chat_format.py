"""Chat formatting: a finite-state machine over roles and a declarative template, native to Spark SQL.

Rows in, conversations out: the turns of a conversation are ordered by turn (then role, then text, so
that ties and repeated rows have one order), checked against the machine, and written with the
template's marks. Control strings inside a text are escaped, so that the text can be read back:
a backslash is doubled, and a backslash goes after the first character of each control string.

Defined cases: a null text or role is empty, a null turn comes first, all rows with a null conv_id are
one conversation, an unknown role gets a mark with its name in hexadecimal, an empty table gives an
empty result. Columns other than conv_id, turn, role and text are ignored. A conversation is the unit
of the result (its text is one value), so the rows of one conversation meet in one task; work there is in proportion to
its turns and characters.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import table


@dataclass(frozen=True)
class Template:
    """Marks and loss flag of each role; machine: the roles that may follow a role ('' is the start)."""

    marks: dict[str, tuple[str, str, bool]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>", False),
            "user": ("[INST]", "[/INST]", False),
            "assistant": ("<s>", "</s>", True),
        }
    )
    other: tuple[str, str, str] = ("<|", "|>", "<|/|>")
    machine: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    final: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        return [x for a, b, _ in self.marks.values() for x in (a, b)] + [self.other[0]]

    def escape_pattern(self) -> str:
        by_first: dict[str, list[str]] = {}
        for c in self.controls():
            by_first.setdefault(c[0], []).append(re.escape(c[1:]))
        return "|".join(f"{re.escape(a)}(?={'|'.join(rest)})" for a, rest in by_first.items())

    def turn_pattern(self) -> str:
        """Groups: 1 the opening mark, 2 the name of another role in hexadecimal, 3 the text."""
        a, b, c = map(re.escape, self.other)
        opens = "|".join(re.escape(x[0]) for x in self.marks.values())
        closes = "|".join(re.escape(x[1]) for x in self.marks.values())
        return f"(?s)({opens}|{a}([0-9A-F]*){b})(.*?)(?:{closes}|{c})"


def _by_role(template: Template, role: Column, known, other) -> Column:
    """known(marks) as the value for each role of the template, else other."""
    out = None
    for name, marks in template.marks.items():
        out = (F if out is None else out).when(role == name, known(marks))
    return out.otherwise(other)


def escaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), template.escape_pattern(), r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation.

    conv_id, formatted, segments (text, kind open/text/close, role, loss, start, end in code points of
    formatted), valid (the machine accepts the roles) and first_bad (index of the first turn that it
    rejects; the number of turns if only the end is wrong; else null).
    """
    a, b, c = template.other
    role = F.col("role")
    # The text between marks is escaped once; the segments are built from that.
    turns = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("raw"))
    turns = turns.select(
        "*",
        _by_role(template, role, lambda m: F.lit(m[0]), F.concat(F.lit(a), F.hex(F.encode(role, "UTF-8")), F.lit(b))).alias("open"),
        escaped(F.col("raw"), template).alias("text"),
        _by_role(template, role, lambda m: F.lit(m[1]), F.lit(c)).alias("close"),
        _by_role(template, role, lambda m: F.lit(m[2]), F.lit(False)).alias("loss"),
    ).withColumns({"n_open": F.length("open"), "n_text": F.length("text"), "n_close": F.length("close")})
    # A turn begins where those before it end: a running sum, so the work is in proportion to the turns.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "raw")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("n_open") + F.col("n_text") + F.col("n_close")).over(before), F.lit(0)).cast("int")
    placed = turns.withColumns({"at": F.row_number().over(order), "start": start})
    turns = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "role", "open", "text", "close", "loss", "start", "n_open", "n_text", "n_close"))).alias("sized"))
    turns = turns.withColumn("roles", F.transform("sized", lambda m: m["role"]))
    segment = lambda text, kind, role, loss, start, n: F.struct(text.alias("text"), F.lit(kind).alias("kind"), role.alias("role"), loss.alias("loss"), start.alias("start"), (start + n).alias("end"))
    segments = F.flatten(
        F.transform(
            "sized",
            lambda m: F.array(
                segment(m["open"], "open", m["role"], F.lit(False), m["start"], m["n_open"]),
                segment(m["text"], "text", m["role"], m["loss"], m["start"] + m["n_open"], m["n_text"]),
                segment(m["close"], "close", m["role"], F.lit(False), m["start"] + m["n_open"] + m["n_text"], m["n_close"]),
            ),
        )
    )
    allowed = F.array(*[F.lit(f"{p}>{q}") for p, after in template.machine.items() for q in after])
    steps = F.transform("roles", lambda r, i: F.concat(F.when(i > 0, F.element_at("roles", i)).otherwise(""), F.lit(">"), r))
    bad = F.array_position(F.transform(steps, lambda s: F.array_contains(allowed, s)), False)
    ends = F.element_at("roles", -1).isin(*template.final)
    out = turns.select(
        "conv_id",
        F.array_join(F.transform("sized", lambda m: F.concat(m["open"], m["text"], m["close"])), "").alias("formatted"),
        segments.alias("segments"),
        F.when(bad > 0, (bad - 1).cast("int")).when(~ends, F.size("roles")).alias("first_bad"),
    )
    return out.withColumn("valid", F.col("first_bad").isNull())


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, turns (role, text), as the formatted text has them, and loss: the texts under the mask, unescaped."""
    pattern = F.lit(template.turn_pattern())
    opened = {marks[0]: role for role, marks in template.marks.items()}
    role_of = lambda mark, name: F.coalesce(*[F.when(mark == m, F.lit(r)) for m, r in opened.items()], F.decode(F.unhex(name), "UTF-8"))
    found = formatted.select(
        "*",
        F.regexp_extract_all("formatted", pattern, F.lit(1)).alias("_marks"),
        F.regexp_extract_all("formatted", pattern, F.lit(2)).alias("_names"),
        F.regexp_extract_all("formatted", pattern, F.lit(3)).alias("_texts"),
    )
    zipped = F.zip_with(F.zip_with("_marks", "_names", lambda m, n: role_of(m, n)), "_texts", lambda r, t: F.struct(r.alias("role"), unescaped(t).alias("text")))
    found = found.withColumn("turns", zipped)
    # The mask has a flag for each text, in the order in which the text has them.
    flags = F.transform(F.filter("segments", lambda s: s["kind"] == "text"), lambda s: s["loss"])
    masked = F.filter(F.zip_with("turns", flags, lambda t, f: F.struct(t["text"].alias("text"), f.alias("loss"))), lambda x: x["loss"])
    return found.select("conv_id", "formatted", "turns", F.transform(masked, lambda x: x["text"]).alias("loss"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql(
        "SELECT CAST(-7 AS BIGINT) conv_id, CAST(turn AS BIGINT) turn, role, '</s>[INST] ok [/INST]' text "
        "FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)"
    )
    back = read_back(format_conversations(rows.unionByName(own)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def oracle_op3() -> str:
    t = Template()
    extra = " + ".join(["length(text) - length(replace(text, chr(92), ''))"] + [f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in t.controls()])
    marks = "CASE role " + " ".join(f"WHEN '{r}' THEN {len(m[0]) + len(m[1])}" for r, m in t.marks.items()) + f" ELSE {len(''.join(t.other))} + 2 * strlen(role) END"
    return f"""
    WITH rows_ AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length(text) + {extra} + {marks}) AS BIGINT) AS formatted_chars
    FROM rows_ GROUP BY conv_id"""
