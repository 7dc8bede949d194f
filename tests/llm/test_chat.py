"""Chat formatting: black-box spans, escaping, rewriting templates, long conversations."""

import hashlib
import random

from retally.llm.chat import InstTemplate, _escaped, format_conversations, formatted_digests, locate, marked_turns

SCHEMA = "conv_id long, turn long, role string, text string, spans string, conv string"
HOSTILE = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "<s", "/s>", "<</s>", "", "[/INST", "] [ROLE x]y[/ROLE]", "\n\n</s", "é日本🙂", " x "]


def test_escaping_is_reversible_and_hides_control_strings():
    rng = random.Random(11)
    for _ in range(2000):
        text = "".join(rng.choices([*HOSTILE, *InstTemplate.CONTROLS, "a", "\\"], k=rng.randrange(0, 6)))
        escaped = _escaped(text)
        assert InstTemplate.unescape(escaped) == text
        assert not any(c in escaped for c in InstTemplate.CONTROLS)


def test_spans_of_random_conversations():
    rng = random.Random(12)
    template = InstTemplate()
    for n in list(range(0, 8)) + [31, 32, 33, 64, 150]:
        turns = [(rng.choice(["user", "assistant", "system", "tool]x"]), rng.choice(HOSTILE)) for _ in range(n)]
        text, spans, at = locate(template, turns)
        assert at is None and text == template(turns) and marked_turns(text) == turns
        assert [InstTemplate.unescape(text[c:d]) for (r, _), (_, _, c, d) in zip(turns, spans) if r == "assistant"] == \
            [t for r, t in turns if r == "assistant"]
        assert [a for a, *_ in spans[1:]] == [b for _, b, *_ in spans[:-1]]


def test_templates_that_rewrite_history_are_detected():
    def forgets(turns):          # keeps the assistant's thoughts of the last turn only
        return "".join(f"{r}:{t};" if k == len(turns) - 1 else f"{r}:{t.split('|')[-1]};" for k, (r, t) in enumerate(turns))

    turns = [("user", "a"), ("assistant", "think|b"), ("user", "c")]
    text, spans, at = locate(forgets, turns)
    assert spans is None and at == 2 and text == forgets(turns)
    assert locate(forgets, turns[:2])[2] is None
    late = [("user", "a"), ("assistant", "b")] * 40 + turns
    assert locate(forgets, late)[2] == 82


def test_templates_that_count_turns_fall_back_to_whole_prefixes():
    def counted(turns):
        return "".join(f"{k}:{r}:{t}\n" for k, (r, t) in enumerate(turns))

    turns = [("assistant" if k % 2 else "user", f"t{k}") for k in range(100)]
    text, spans, at = locate(counted, turns)
    assert at is None and [text[c:d] for (r, _), (_, _, c, d) in zip(turns, spans) if r == "assistant"] == [t for r, t in turns if r == "assistant"]


def test_digests_and_edge_cases(spark):
    rows = [(1, 1, "assistant", "b", "x", "y"), (1, 0, "user", "a", "x", "y"), (2, 0, "assistant", None, "x", "y"), (3, 0, None, "z", "x", "y"),
            (None, 0, "user", "n", "x", "y"), (4, 0, "user", "same", "x", "y"), (4, 0, "user", "same", "x", "y"),
            (5, None, "system", "s", "x", "y"), (5, 1, "assistant", "long " * 50000, "x", "y")]
    rows += [(6, k, "user" if k % 2 else "assistant", f"turn {k} </s>", "x", "y") for k in range(500)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.conv_id: r for r in formatted_digests(frame).collect()}
    want = {}
    for conv, turn, role, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        joined = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) == (
            len(turns), hashlib.sha256(joined.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(InstTemplate()(turns)))
    assert format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_step_one_sees_rewriting_that_is_undone_later(spark):
    plain = InstTemplate()

    def passing(turns):
        return plain([("user", "changed"), *turns[1:]] if len(turns) == 40 else turns)

    turns = [("user" if k % 2 == 0 else "assistant", f"text {k}") for k in range(64)]
    rows = spark.createDataFrame([(1, k, *t) for k, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    assert format_conversations(rows, passing, step=1).first().rewritten_at == 39
    whole = format_conversations(rows, step=1).first()
    assert whole.rewritten_at is None and whole == format_conversations(rows).first()


def test_every_prefix_is_rendered_by_default_wherever_it_is(spark):
    """Rewriting that is undone a few turns later is seen early and late in a conversation alike."""
    plain = InstTemplate()
    turns = [("user" if k % 2 == 0 else "assistant", f"text {k}") for k in range(64)]
    for n in (7, 36, 40, 61):
        def passing(given, n=n):
            return plain([given[0], ("assistant", "changed"), *given[2:]] if len(given) == n else given)

        assert locate(passing, turns)[2] == n - 1
    rows = spark.createDataFrame([(1, k, *t) for k, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    assert format_conversations(rows, passing).first().rewritten_at == 60


def test_read_back_of_rewritten_and_foreign_outputs(spark):
    from retally.llm.chat import read_back

    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "assistant", "d")],
                                 "conv_id long, turn long, role string, text string")

    def forgets(turns):
        return "".join(f"{r}:{t};" if k == len(turns) - 1 else f"{r};" for k, (r, t) in enumerate(turns))

    got = {r.conv_id: r for r in read_back(format_conversations(rows, forgets)).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256, got[1].turns_sha256) == (None, None, None, None)
    assert got[1].formatted_chars == len("user;assistant;user:c;")
    assert (got[2].n_turns, got[2].loss_chars, got[2].loss_sha256) == (None, 1, hashlib.sha256(b"d").hexdigest())
