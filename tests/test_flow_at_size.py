"""An answer store opens its file system once in a process, and travels as its URI."""

import pickle

from pairquarry.operators.answers import AnswerStore, Reply


def test_a_store_opens_its_file_system_once(tmp_path):
    store = pickle.loads(pickle.dumps(AnswerStore(f"file:{tmp_path}/s")))
    store.put("ab12", Reply("x"))
    assert store._place("ab12")[0] is store._place("cd34")[0]
    assert pickle.loads(pickle.dumps(store)).get("ab12") == Reply("x")
