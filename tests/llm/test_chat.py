import hashlib
import random

import pytest

from tidemark.llm.chat import Template, chat_report, format_chats, read_back


@pytest.fixture
def turns(rows):
    return lambda data: rows("conv_id long, turn long, role string, text string, formatted int", [(*d, 1) for d in data])


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(data):
    talks = {}
    for conv, turn, role, text in data:
        # a row of no conversation is one by itself
        talks.setdefault(("alone", turn, role, text) if conv is None else conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, t in talks.items():
        t.sort()
        loss = "".join(x for *_, r, x in t if r == "assistant")
        out[conv] = (len(t), digest("".join(f"{r}\n{x}\n" for *_, r, x in t)), len(loss), digest(loss))
    return out


def messy(rng):
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ANS>>", "<", "[", "\\", "/s>", "<\\/s>", "[\\\\INST]", " ", "\n", "é", "$1", "[ROLE] ", " [/ROLE] ", "ok"]
    return "".join(rng.choices(bits, k=rng.randrange(12)))


def test_read_back_is_exact(turns):
    rng = random.Random(4)
    data = [(c, t, rng.choice(["user", "assistant", "system", "tool", "x [/ROLE] y", "a\\", "", None]), rng.choice([messy(rng), None])) for c in range(80) for t in range(rng.randrange(1, 9))]
    data += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    data += [(900, 1, "user", "b"), (900, 1, "user", "a"), (900, None, "system", "first"), (None, 0, "user", "n"), (None, 1, "assistant", "long " * 50000)]
    data += [(None, 0, "user", "n")]
    report = chat_report(turns(data)).collect()
    got = sorted((r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in report)
    assert got == sorted(brute(data).values())
    known = {r.conv_id: r.turns_sha256 for r in report if r.conv_id is not None}
    assert known == {c: v[1] for c, v in brute(data).items() if not isinstance(c, tuple)}
    assert sorted(r.n_turns for r in report if r.conv_id is None) == [1, 2]


def test_a_role_spelled_as_a_state_is_refused(turns):
    data = [(1, 0, "user", "u"), (1, 1, "assistant", "a"), (1, 2, "<end>", "x"), (2, 0, "<start>", "x"), (2, 1, "user", "u"), (2, 2, "assistant", "a")]
    out = {r.conv_id: r for r in read_back(format_chats(turns(data))).collect()}
    assert (out[1].accepted, out[1].refused_at) == (False, 2) and (out[2].accepted, out[2].refused_at) == (False, 0)
    assert [t.role for t in out[1].turns] == ["user", "assistant", "<end>"]


def test_machine_template_and_loss(turns):
    data = [
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "</s>"),
        (2, 0, "user", "u"), (2, 1, "user", "v"),
        (3, 0, "user", "u"),
        (4, 0, "assistant", "a"),
    ]
    out = {r.conv_id: r for r in read_back(format_chats(turns(data))).collect()}
    assert out[1].formatted == "<s><<SYS>> s <</SYS>></s><s>[INST] u [/INST]</s><s><<ANS>> <\\/s> <</ANS>></s>"
    assert [s.text for s in out[1].segments if s.loss] == ["<\\/s>"]
    assert "".join(s.text for s in out[1].segments) == out[1].formatted
    assert (out[1].accepted, out[1].refused_at) == (True, None)
    assert (out[2].accepted, out[2].refused_at) == (False, 1)
    assert (out[3].accepted, out[3].refused_at) == (False, 1)
    assert (out[4].accepted, out[4].refused_at) == (False, 0)
    assert [tuple(t) for t in out[1].turns][2] == ("assistant", "</s>")


def test_other_template(turns):
    template = Template(begin="{{", end="|}", marks={"user": ("U: ", ""), "assistant": ("A: ", "")}, loss_roles=("user", "assistant"), escape="~")
    data = [(1, 0, "user", "{{x|} {~{ U: "), (1, 1, "assistant", "|}"), (1, 2, "other", "t")]
    out = read_back(format_chats(turns(data), template), template).first()
    assert [tuple(t) for t in out.turns] == [("user", "{{x|} {~{ U: "), ("assistant", "|}"), ("other", "t")]


def test_no_python_and_empty(turns):
    from tests.conftest import final_plan_of

    frame = chat_report(turns([(1, 0, "user", "x")]))
    assert "Python" not in final_plan_of(frame) and "Arrow" not in final_plan_of(frame)
    assert chat_report(turns([(1, 0, "user", "x")]).limit(0)).collect() == []
