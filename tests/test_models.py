import json
import threading
import time

import numpy as np
import pytest
from faultline.functions.vectors import cosine, l2
from faultline.operators.models import (ModelSpec, call_with_retry, hashing_embed, letter_counts, ml_predict,
                                        quoting_planner, remote_embedder, remote_planner)
from faultline.operators.vector_search import vector_search
from pyspark.sql import functions as F


def spec(open_client, output="STRING", **options):
    return ModelSpec("m", output, open_client, backoff_s=0.0, **options)


def texts(spark, values, parts=2):
    return spark.createDataFrame(list(enumerate(values)), "id INT, text STRING").repartition(parts)


def test_one_output_per_row_and_null_stays_null(spark):
    df = texts(spark, ["abc", None, "", "zz a"])
    done = {r.id: r.v for r in ml_predict(df, spec(letter_counts, "ARRAY<FLOAT>"), "text", out="v").collect()}
    assert done[1] is None and sum(done[2]) == 0 and done[0][:3] == [1, 1, 1] and done[3][25] == 2


def test_chunks_and_order(spark):
    def sizes(_):
        return lambda chunk: [f"{t}:{len(chunk)}" for t in chunk]
    df = texts(spark, [str(i) for i in range(250)], parts=1)
    done = ml_predict(df, spec(sizes), "text", out="o", batch_size=100).collect()
    assert all(r.o.split(":")[0] == r.text for r in done)
    assert sorted({r.o.split(":")[1] for r in done}) == ["100", "50"]


def test_calls_in_flight_are_bounded(spark):
    def watched(_):
        state = {"now": 0, "most": 0}
        lock = threading.Lock()

        def call(chunk):
            with lock:
                state["now"] += 1
                state["most"] = max(state["most"], state["now"])
            time.sleep(0.02)
            with lock:
                state["now"] -= 1
            return [str(state["most"]) for _ in chunk]
        return call
    df = texts(spark, [str(i) for i in range(40)], parts=1)
    done = ml_predict(df, spec(watched), "text", out="o", batch_size=1, max_in_flight=3).collect()
    assert max(int(r.o) for r in done) == 3


def test_failure_gives_null_and_reason(spark):
    def broken(_):
        def call(chunk):
            if "bad" in chunk:
                raise TimeoutError("too slow")
            return chunk
        return call
    df = texts(spark, ["good", "bad", "fine"])
    done = {r.text: (r.o, r.why) for r in ml_predict(
        df, spec(broken), "text", out="o", batch_size=1, error="why").collect()}
    assert done["good"] == ("good", None) and done["bad"] == (None, "TimeoutError: too slow")


def test_retry_succeeds_before_attempts_run_out():
    tries = []

    def flaky(chunk):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("again")
        return chunk
    assert call_with_retry(flaky, ["x"], spec(None)) == [("x", None)] and len(tries) == 3
    assert call_with_retry(lambda c: [], ["x"], spec(None))[0][1].startswith("ValueError")


def test_distinct_calls_once_per_text(spark, tmp_path):
    folder = str(tmp_path)

    def noted(_):
        def call(chunk):
            for t in chunk:
                with open(f"{folder}/{t}", "a") as f:
                    f.write(".")
            return [t.upper() for t in chunk]
        return call
    df = texts(spark, ["a", "b", "a", "a", None])
    done = ml_predict(df, spec(noted), "text", out="o", distinct=True).collect()
    assert sorted((r.id, r.o) for r in done) == [(0, "A"), (1, "B"), (2, "A"), (3, "A"), (4, None)]
    assert (tmp_path / "a").read_text() == "."


def test_model_is_not_called_again_for_a_filter_on_its_output(spark, tmp_path):
    folder = str(tmp_path)

    def noted(_):
        def call(chunk):
            with open(f"{folder}/calls", "a") as f:
                f.write("." * len(chunk))
            return chunk
        return call
    df = texts(spark, ["a", "b", "c"])
    kept = ml_predict(df, spec(noted), "text", out="o", error="e").where("o <> 'b' and e is null")
    assert kept.count() == 2 and (tmp_path / "calls").read_text() == "..."


def test_remote_clients_speak_the_wire_format(spark, monkeypatch):
    seen = []

    def transport(url, body, key, timeout):
        seen.append((url, body, key, timeout))
        if url.endswith("/embeddings"):
            return {"data": [{"index": i, "embedding": [len(t), 1]} for i, t in reversed(list(enumerate(body["input"])))]}
        return {"choices": [{"message": {"content": body["messages"][-1]["content"].upper()}}]}
    monkeypatch.setenv("SOME_KEY", "secret")
    common = dict(endpoint="http://models/v1", key_env="SOME_KEY", options={"transport": transport})
    vectors = remote_embedder(spec(None, **common))(["a", "bbb"])
    assert [v.tolist() for v in vectors] == [[1, 1], [3, 1]]
    assert remote_planner(spec(None, system_prompt="be brief", **common))(["go"]) == ["GO"]
    assert [s[0] for s in seen] == ["http://models/v1/embeddings", "http://models/v1/chat/completions"]
    assert seen[0][2] == "secret" and [m["role"] for m in seen[1][1]["messages"]] == ["system", "user"]


def test_key_is_in_no_plan(spark, monkeypatch):
    monkeypatch.setenv("SOME_KEY", "very-secret")
    done = ml_predict(texts(spark, ["a"]), spec(quoting_planner, key_env="SOME_KEY"), "text")
    assert "very-secret" not in done._jdf.queryExecution().toString()


def test_quoting_planner_refuses_without_section():
    assert json.loads(quoting_planner(None)(["nothing"])[0])["diagnosis"] == "insufficient documentation"


def test_hashed_words_find_the_same_text(spark):
    corpus = texts(spark, ["pump leaks oil", "door will not close", ""]).withColumnsRenamed({"id": "sid", "text": "t"})
    probes = texts(spark, ["the pump leaks", "", None])
    found = vector_search(hashing_embed(probes, "text", "v"), hashing_embed(corpus, "t", "vec"), "v", "vec",
                          key="id", corpus_key="sid").collect()
    assert [(r.id, r.sid) for r in found] == [(0, 0)]  # empty text has no direction


def test_vector_expressions(spark):
    row = spark.sql("SELECT array(3f, 4f) a, array(0f, 2f) b, array(0f, 0f) z").select(
        cosine("a", "b").alias("c"), l2("a", "b").alias("d"), cosine("a", "z").alias("n")).first()
    assert row.c == pytest.approx(0.8) and row.d == pytest.approx(np.sqrt(13)) and row.n is None


def test_stamp_is_taken_after_the_call(spark):
    def slow(_):
        def call(chunk):
            time.sleep(0.3)
            return chunk
        return call
    df = texts(spark, ["a", "b"], parts=1).withColumn("started", F.current_timestamp().cast("timestamp_ntz"))
    done = ml_predict(df, spec(slow), "text", out="o", batch_size=1, max_in_flight=1, stamp="t")
    waits = done.select("o", F.timestamp_diff("MILLISECOND", "started", "t").alias("w")).collect()
    assert min(r.w for r in waits) >= 600


def test_one_bad_text_does_not_take_its_chunk_along():
    def call(texts):
        if "bad" in texts:
            raise ValueError("refused")
        return [t.upper() for t in texts]
    spec = ModelSpec("m", "STRING", lambda spec: call, attempts=2, backoff_s=0.0)
    assert call_with_retry(call, ["a", "bad", "b"], spec) == [("A", None), (None, "ValueError: refused"), ("B", None)]
