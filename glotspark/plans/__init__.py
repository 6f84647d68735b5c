from .jobs import (
    learn,
    learn_and_predict,
    learn_from,
    predict_into,
    predict_job,
    predict_new,
    score_texts,
)

__all__ = [
    "learn",
    "learn_and_predict",
    "learn_from",
    "predict_into",
    "predict_job",
    "predict_new",
    "score_texts",
]
