from lectern.operators.inference import EchoModel, backoff_wait, call_with_retry, infer


class Flaky:
    def __init__(self, fails):
        self.fails = fails
        self.calls = 0

    def __call__(self, p):
        self.calls += 1
        if self.calls <= self.fails:
            raise TimeoutError("busy")
        return p.upper()


def test_backoff_schedule():
    assert [backoff_wait(a, 5, 40) for a in (1, 2, 3, 4, 5)] == [5, 10, 20, 40, 40]
    assert backoff_wait(3, 5, None) == 20


def test_retry_then_success_and_give_up():
    waits = []
    r = call_with_retry(Flaky(2), "hi", 4, 5, 40, 1.0, sleep=waits.append)
    assert r == ("HI", None, 3)
    assert waits == [5, 10, 1.0]
    waits.clear()
    r = call_with_retry(Flaky(10), "hi", 3, 5, None, 1.0, sleep=waits.append)
    assert r[0] is None and r[1].startswith("TimeoutError") and r[2] == 3
    assert waits == [5, 10]


def test_infer_errors_are_rows(spark):
    prompts = ["a" * n for n in range(1, 40)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prompts)], "id long, prompt string").repartition(3)
    out = {r.id: r for r in infer(df, "prompt", EchoModel(), ["id"], retries=3, multiplier=0, cap=0, pause=0).collect()}
    assert len(out) == len(prompts)
    for i, p in enumerate(prompts):
        r = out[i]
        if len(p) % 11 == 0:
            assert r.response is None and r.error == "RuntimeError: model unavailable" and r.attempts == 3
        else:
            assert r.error is None and f'"n": {len(p)}' in r.response
            assert r.attempts == (2 if len(p) % 7 == 0 else 1)
