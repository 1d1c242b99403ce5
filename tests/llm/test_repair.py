"""Conversation repair against plain search, and a long conversation over many segments."""

import hashlib
import random
import re

import pytest

from tidemark.llm import repair as R

SPACE = " \t\n\x0b\x0c\r"


def every_audit(rows):
    """(cost, audit, lines) of all ways to edit a short list of (role, text, fault), by search."""
    n = len(rows)

    def go(i, roles, lines, cost, audit, inserted):
        if i == n and re.fullmatch("(s?(ua)+)?", roles):
            yield cost, audit, lines
        if inserted < n + 2:
            for name in ("user", "assistant"):
                if re.match("(s?(ua)*u?)?$", roles + name[0]):
                    yield from go(i, roles + name[0], [*lines, f"{name}:"], cost + 2, audit + "I", inserted + 1)
        if i < n:
            role, text, fault = rows[i]
            late = int(fault == "truncated")
            yield from go(i + 1, roles, lines, cost + 3, audit + "D", inserted)
            if fault not in ("blank", "duplicate"):
                ways = [(0, role, "K"), (2, "user", "R"), (2, "assistant", "R")]
                for price, name, op in ways:
                    grown = roles + name[:1]
                    if len(grown) > len(roles) and re.match("(s?(ua)*u?)?$", grown):
                        yield from go(i + 1, grown, [*lines, f"{name}:{text}"], cost + price + late, audit + op, inserted)

    return go(0, "", [], 0, "", 0)


def table(rows):
    """The same by states, for long lists."""
    best = {"": (0, "")}  # role pattern so far, shortened to its last role
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def insert(states):
        out = dict(states)
        for _ in range(2):
            for s, (c, a) in list(out.items()):
                for r, t in step[s].items():
                    if r != "s":
                        out[t] = min(out.get(t, (c + 2, a + "I")), (c + 2, a + "I"))
        return out

    for role, _, fault in rows:
        new = {}
        late = int(fault == "truncated")
        for s, (c, a) in insert(best).items():
            ways = [(s, c + 3, a + "D")]
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in step[s]:
                    ways.append((step[s][role[:1]], c + late, a + "K"))
                ways += [(t, c + 2 + late, a + "R") for r, t in step[s].items() if r != "s"]
            for t, cost, audit in ways:
                new[t] = min(new.get(t, (cost, audit)), (cost, audit))
        best = new
    return min(v for s, v in insert(best).items() if s in ("", "a"))


def judged(rows):
    """(role, text, fault) of (turn, role, text) in order."""
    named = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    ordered = sorted(named, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    out, seen = [], set()
    for _, role, text in ordered:
        core = text.strip(SPACE)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "fine" if core[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return ordered, out


def expected(rows):
    ordered, found = judged(rows)
    turns = [t for t, _, _ in ordered if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(ordered, ordered[1:], strict=False)]
    count = lambda kind: sum(f == kind for _, _, f in found)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": count("blank"),
        "duplicate": count("duplicate"),
        "truncated": count("truncated"),
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
    }


def test_solve_is_the_least_of_all_edits():
    rng = random.Random(5)
    kinds = {"fine": R.FINE, "blank": R.BLANK, "duplicate": R.DUPLICATE, "truncated": R.TRUNCATED}
    for _ in range(300):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), "x", rng.choice(list(kinds))) for _ in range(rng.randint(0, 4))]
        cost, audit, lines = min(every_audit(rows))
        codes = bytes(R._row_code(role[:1], kinds[fault]) for role, _, fault in rows)
        assert R.solve(codes) == (cost, audit) == table(rows)
        said = R.apply_audit(audit, [{"role": r, "text": x} for r, x, _ in rows])
        assert [f"{t['role']}:{t['text']}" for t in said] == lines


def collected(pieces):
    out = {}
    for row in sorted(pieces.collect(), key=lambda r: (r["range"], r["part"])):
        mine = out.setdefault(row["conv_id"], {"audit": "", "lines": [], "ids": 0})
        mine["audit"] += row["audit"]
        mine["lines"] += [f"{t['role']}:{t['text']}" for t in row["turns"]]
        mine["ids"] += 1
        if row["cost"] is not None:
            mine |= {c: row[c] for c in R.SUMS}
    return out


@pytest.fixture
def conversations(spark):
    rng = random.Random(11)
    texts = ["", " \t", "Yes.", "No", "Why? ", "ok!\n", None]
    roles = ["system", "user", "assistant", "tool", None, "", "user"]
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts))
        for _ in range(200)
    ]
    long_ = [(1000, i, ("user", "assistant")[i % 2] if rng.random() < 0.9 else "system", f"turn {i}{rng.choice('.!')}") for i in range(9_000)]
    long_ += [(1000, i, "user", f"turn {i}.") for i in rng.choices(range(9_000), k=500)]
    long_ += [(1001, None, "user", "same text.")] * 700
    rows += long_
    rng.shuffle(rows)
    return rows


def test_conversations_of_all_kinds(spark, conversations):
    df = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS fault", "1 AS part")
    found = collected(R.repaired(df))
    groups = {}
    for c, *row in conversations:
        groups.setdefault(c, []).append(tuple(row))
    assert set(found) == set(groups) and found[1000]["ids"] > 2
    for c, rows in groups.items():
        cost, audit = table(judged(rows)[1])
        lines = R.apply_audit(audit, [{"role": r, "text": x} for r, x, _ in judged(rows)[1]])
        assert found[c]["audit"] == audit and found[c]["cost"] == cost, c
        assert found[c]["lines"] == [f"{t['role']}:{t['text']}" for t in lines]
        assert {k: found[c][k] for k in expected(rows)} == expected(rows)
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in found[c]["lines"]))


def test_report_of_whole_and_cut_conversations(spark, conversations):
    df = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string")
    report = {r["conv_id"]: r for r in R.repair_report(df).collect()}
    pieces = collected(R.repaired(R.damaged(df)))
    assert set(report) == {c for c, *_ in conversations} and set(pieces) <= set(report)
    for c, row in report.items():
        mine = pieces.get(c, {"audit": "", "lines": [], **dict.fromkeys(R.SUMS, 0)})
        assert row["repaired_sha256"] == hashlib.sha256("\n".join(mine["lines"]).encode()).hexdigest()
        assert row["audit"] == mine["audit"] and [row[s] for s in R.SUMS] == [mine[s] for s in R.SUMS]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair_report(empty).count() == 0 and R.repaired(empty).count() == 0
