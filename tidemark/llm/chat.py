"""Chat formatting: a state machine over roles and a declarative template.

``TRANSITIONS`` is the machine: which role may follow which.  ``Template`` says how a turn
of each role is marked and whether its text counts for the loss.  Formatting emits one
list of segments (text, loss) per conversation; their concatenation is the training text.
Control strings inside a turn's text are escaped, so that the output can always be read
back.  Built-in column expressions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<start>", "<end>"
#: state: roles that may come next.
TRANSITIONS = {
    START: ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user", "tool", END),
    "tool": ("assistant",),
}


@dataclass(frozen=True)
class Template:
    """A turn is ``begin + open + text + close + end`` with the marks of its role; a role
    without marks is written as ``begin + other[0] + role + other[1] + text + end``."""

    begin: str = "<s>"
    end: str = "</s>"
    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>> ", " <</SYS>>"),
            "user": ("[INST] ", " [/INST]"),
            "assistant": ("<<ANS>> ", " <</ANS>>"),
        }
    )
    other: tuple[str, str] = ("[ROLE] ", " [/ROLE] ")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Put after the first character of a control string inside a text.
    escape: str = "\\"

    def controls(self) -> list[str]:
        parts = {self.begin, self.end, *self.other}
        for marks in self.marks.values():
            parts |= set(marks)
        found = sorted({p.strip() for p in parts} - {""}, key=lambda p: (-len(p), p))
        if any(len(p) < 2 for p in found):
            raise ValueError("a mark needs two characters, between which an escape can stand")
        if any(self.end.endswith(self.end[:k]) for k in range(1, len(self.end))):
            raise ValueError("the end mark must not overlap itself")
        return found

    def _pattern(self, escapes: str) -> str:
        """Matches the place after the first character of a control string, with so many
        escapes as stand there."""
        heads: dict[str, list[str]] = {}
        for c in self.controls():
            heads.setdefault(c[0], []).append(re.escape(c[1:]))
        e = re.escape(self.escape)
        return "|".join(
            f"(?:(?<={re.escape(h)}){e}{escapes}(?={'|'.join(tails)}))" for h, tails in heads.items()
        )

    def escaped(self, text: Column) -> Column:
        """One more escape in every control string, escaped or not."""
        mark = self.escape.replace("\\", "\\\\").replace("$", "\\$")
        return F.regexp_replace(text, F.lit(f"(?:{self._pattern('*')})"), F.lit(f"{mark}$0"))

    def unescaped(self, text: Column) -> Column:
        """The inverse of ``escaped``."""
        e = re.escape(self.escape)
        tails = self._pattern("*").replace(f"{e}*", f"{e}({e}*)")
        groups = "".join(f"${i + 1}" for i in range(len({c[0] for c in self.controls()})))
        return F.regexp_replace(text, F.lit(f"(?:{tails})"), F.lit(groups))

    def _known(self, role: Column, of) -> Column:
        out = None
        for name in self.marks:
            hit = role == name
            out = F.when(hit, of(name)) if out is None else out.when(hit, of(name))
        return out

    def segments(self, role: Column, text: Column) -> Column:
        """The turn as (text, loss) segments: mark, text, mark."""
        body = self.escaped(text)
        opening = self._known(role, lambda r: F.lit(self.begin + self.marks[r][0])).otherwise(
            F.concat(F.lit(self.begin + self.other[0]), self.escaped(role), F.lit(self.other[1]))
        )
        closing = self._known(role, lambda r: F.lit(self.marks[r][1] + self.end)).otherwise(
            F.lit(self.end)
        )
        part = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
        return F.array(
            part(opening, F.lit(False)),
            part(body, role.isin(*self.loss_roles)),
            part(closing, F.lit(False)),
        )

    def read_turn(self, turn: Column) -> Column:
        """(role, text) of one turn, without its end mark."""
        inner = F.substring(turn, F.lit(len(self.begin) + 1), F.length(turn))
        known = None
        for name, (opens, closes) in self.marks.items():
            body = F.substring(
                inner, F.lit(len(opens) + 1), F.length(inner) - len(opens) - len(closes)
            )
            found = F.struct(F.lit(name).alias("role"), self.unescaped(body).alias("text"))
            hit = F.startswith(inner, F.lit(opens))
            known = F.when(hit, found) if known is None else known.when(hit, found)
        opens, closes = self.other
        rest = F.substring(inner, F.lit(len(opens) + 1), F.length(inner))
        at = F.instr(rest, F.lit(closes))
        return known.otherwise(
            F.struct(
                self.unescaped(F.substring(rest, F.lit(1), at - 1)).alias("role"),
                self.unescaped(F.substring(rest, at + len(closes), F.length(rest))).alias("text"),
            )
        )


def _allowed(state: Column, role: Column) -> Column:
    pairs = [F.lit(f"{a}\n{b}") for a, follows in TRANSITIONS.items() for b in follows]
    return F.array_contains(F.array(*pairs), F.concat(state, F.lit("\n"), role))


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): n_turns, the
    ``segments`` (text, loss), their concatenation ``formatted``, whether the machine
    accepts the order of roles, and the place (from 0) of the first turn it refuses: the
    number of turns if the conversation breaks off.

    Turns go by number; equal numbers go by role, then text.  A null number stands first; a
    null text or role is empty; a row with a null conv_id is a
    conversation by itself, with the rows that equal it.  Refused
    conversations are formatted all the same.  Other columns are not looked at.  An empty
    table gives an empty one.  A conversation is one row of the result, as its text is.
    """
    template = template or Template()
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # Rows of no conversation do not become one that grows with the table.
    alone = F.when(F.col("conv_id").isNull(), F.struct("turn", "role", "text"))
    talks = rows.groupBy("conv_id", alone.alias("alone")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull(), "turn", "role", "text"))).alias("t")
    )
    n = F.size("t")
    # A role that is spelled as the machine's own states is none of them.
    role = lambda x: F.when(x.role.isin(START, END), F.concat(x.role, F.lit("?"))).otherwise(x.role)
    roles = F.concat(F.array(F.lit(START)), F.transform("t", role), F.array(F.lit(END)))
    steps = F.arrays_zip(
        F.slice(roles, F.lit(1), n + 1).alias("a"), F.slice(roles, F.lit(2), n + 1).alias("b")
    )
    refused = F.array_position(F.transform(steps, lambda s: _allowed(s["a"], s["b"])), False) - 1
    segments = F.flatten(F.transform("t", lambda x: template.segments(x.role, x.text)))
    return talks.select(
        "conv_id",
        n.cast("long").alias("n_turns"),
        segments.alias("segments"),
        F.array_join(F.transform(segments, lambda s: s.text), "").alias("formatted"),
        F.when(refused >= 0, refused).alias("refused_at"),
        (refused < 0).alias("accepted"),
    )


def read_back(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """``chats`` with ``turns``: the (role, text) of every turn, parsed from ``formatted``."""
    template = template or Template()
    parts = F.split("formatted", re.escape(template.end))
    turns = F.transform(F.slice(parts, 1, F.size(parts) - 1), template.read_turn)
    return chats.withColumn("turns", turns)


def chat_report(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of what ``read_back`` finds in the output of ``format_chats``, and of the
    text under the loss mask."""
    template = template or Template()
    chats = read_back(format_chats(turns, template), template)
    said = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    masked = F.filter("segments", lambda s: s.loss)
    loss = F.array_join(F.transform(masked, lambda s: template.unescaped(s.text)), "")
    return chats.withColumns({"_said": F.array_join(said, ""), "_loss": loss}).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode("_said", "UTF-8"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "accepted",
        F.col("refused_at").cast("long").alias("refused_at"),
    )
