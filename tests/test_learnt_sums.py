"""The query that learns in two parts."""

import __spark_entry__ as entry


def test_one_guesser_serves_both_parts(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    made, learnt = [], []

    class Registry:
        def __init__(self, *_):
            pass

        def load_sums(self, name):
            return type("Sums", (), {"counts": name})

    def learn_from(texts, step, *_):
        learnt.append((step, sorted(row.doc_id for row in texts.collect())))

    def guess_step(*_):
        made.append(len(made))
        return made[-1]

    monkeypatch.setattr(entry, "documents", lambda *_: rows)
    monkeypatch.setattr(entry, "ModelRegistry", Registry)
    monkeypatch.setattr(entry, "new_path", lambda *_: "nowhere")
    monkeypatch.setattr(entry, "learn_from", learn_from)
    monkeypatch.setattr(entry, "guess_step", guess_step)
    assert entry.learnt_sums(spark, "nowhere") == "language"
    assert made == [0] and [step for step, _ in learnt] == [0, 0]
    # Every row is in one of the parts.
    assert sorted(learnt[0][1] + learnt[1][1]) == list(range(20)) and all(part for _, part in learnt)
