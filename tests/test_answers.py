import json

import pytest

from pairquarry.operators import answers, external
from pairquarry.operators.answers import AnswerStore, Reply, asked_once, usage, wait_before


@pytest.fixture
def store(tmp_path):
    return AnswerStore(str(tmp_path / "store"))


def counting(folder, answer=lambda p: json.dumps({"verdict": "HIGH_VALUE", "summary": p})):
    """A stand-in that leaves a file for each call it gets."""
    folder.mkdir()

    def ask(prompt):
        import uuid

        (folder / f"{prompt}-{uuid.uuid4().hex}").write_text("")
        return Reply(answer(prompt), len(prompt), 7)

    return ask, lambda: sorted(f.name.rpartition("-")[0] for f in folder.iterdir())


def rows(spark, *prompts):
    return spark.createDataFrame([(n, p) for n, p in enumerate(prompts)], "k int, p string")


def test_store(store):
    assert store.get("ab12") is None
    store.put("ab12", Reply("é", 3, 4))
    assert store.get("ab12") == Reply("é", 3, 4)


def test_equal_prompts_and_later_runs_ask_once(spark, tmp_path, store):
    ask, calls = counting(tmp_path / "calls")
    found = asked_once(rows(spark, "a", "b", "a", None), "k", "p", ask, store, interval=0)
    got = {r.k: (r.answer, r.error, r.attempts, r.input_tokens) for r in found.collect()}
    assert got[0] == got[2] == ('{"verdict": "HIGH_VALUE", "summary": "a"}', None, 1, 1)
    assert got[3] == (None, "no prompt", 0, 0)
    assert usage(found).first().asDict() == {"prompts": 4, "different": 2, "answered": 2, "failed": 1, "calls": 2, "input_tokens": 2, "output_tokens": 14}
    again = asked_once(rows(spark, "a", "c"), "k", "p", ask, store, interval=0)
    assert {r.k: r.attempts for r in again.collect()} == {0: 0, 1: 1}
    assert calls() == ["a", "b", "c"]


def test_a_task_that_is_run_again_asks_only_for_the_rest(spark, tmp_path, store):
    ask, calls = counting(tmp_path / "calls")
    prompts = [f"p{n:02}" for n in range(12)]

    class Killed(BaseException):
        """What no handler of failures catches, as a lost executor."""

    def dies(prompt):
        if prompt == "p07":
            raise Killed
        return ask(prompt)

    with pytest.raises(Exception, match="Killed"):
        asked_once(rows(spark, *prompts), "k", "p", dies, store, tasks=1, interval=0)
    first = calls()
    assert "p07" not in first
    found = asked_once(rows(spark, *prompts), "k", "p", ask, store, tasks=1, interval=0).collect()
    assert calls() == prompts and {r.k for r in found if r.attempts == 0} == {int(p[1:]) for p in first}


def test_attempts_and_errors(spark, tmp_path, store):
    def ask(prompt):
        if prompt == "mute":
            return "no idea"
        if prompt == "wrong":
            raise KeyError("x")
        marks = tmp_path / prompt
        marks.mkdir(exist_ok=True)
        n = len(list(marks.iterdir()))
        (marks / str(n)).write_text("")
        if prompt == "late" or n < 2:
            raise TimeoutError("late")
        return "{}"

    found = {r.k: (r.answer, r.error, r.attempts) for r in asked_once(rows(spark, "mute", "wrong", "late", "third"), "k", "p", ask, store, interval=0, sleep=lambda s: None).collect()}
    assert found == {0: (None, "ValueError: no JSON in the answer: 'no idea'", 1), 1: (None, "KeyError: 'x'", 1), 2: (None, "TimeoutError: late", 3), 3: ("{}", None, 3)}
    # Failures aren't kept.
    assert {r.k: r.attempts for r in asked_once(rows(spark, "mute", "third"), "k", "p", ask, store, interval=0).collect()} == {0: 1, 1: 0}


def test_waits_grow_within_bounds():
    assert [wait_before(n) for n in (1, 2, 4, 5, 9)] == [10, 10, 16, 32, 120]


def test_tasks_share_the_pace(spark, store):
    def ask(prompt):
        import time

        return json.dumps({"at": time.time()})

    found = asked_once(rows(spark, *[f"q{n}" for n in range(8)]), "k", "p", ask, store, tasks=2, interval=0.2).collect()
    at = sorted(json.loads(r.answer)["at"] for r in found)
    # Eight calls, two tasks at half the rate each; how prompts fall to tasks is a matter of their hashes.
    assert at[-1] - at[0] >= 0.2 * 2 * 3 - 0.05


def test_answers_give_labels(spark, tmp_path, store):
    ask, _ = counting(tmp_path / "calls")
    labelled = external.labels(asked_once(rows(spark, "a", None), "k", "p", ask, store, interval=0), "k").collect()
    assert [(r.k, r.verdict, r.summary) for r in labelled] == [(0, "HIGH_VALUE", "a")]


def test_nothing_to_ask(spark, store):
    none = asked_once(rows(spark, "a").limit(0), "k", "p", lambda p: 1 / 0, store, interval=0)
    assert none.count() == 0 and usage(none).first().prompts == 0
    assert answers.INTERVAL == 5
