"""Batch scoring by a pluggable model, loaded once per worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Scorer = Callable[[list[str]], list[tuple[float, float, float]]]
SCHEMA = "id string, sentiment_label string, sentiment_score double, confidence double, prob_negative double, prob_neutral double, prob_positive double"
LABELS = ("negative", "neutral", "positive")
# Words of the default scorer.
UP = ("tăng", "phục hồi", "vượt", "lập đỉnh", "rose", "beat", "edged up", "增长", "回升", "上昇", "เพิ่มขึ้น")
DOWN = ("giảm", "mất gần", "rơi xuống", "khoản lỗ", "thu hẹp", "fell", "slipped", "narrowed", "下滑", "跌至", "下げた", "ลดลง")


def lexicon_scorer() -> Scorer:
    """A deterministic stand-in for a trained model: the balance of words of rise and of fall."""

    def score(texts: list[str]) -> list[tuple[float, float, float]]:
        out = []
        for text in texts:
            low = text.lower()
            up, down = sum(low.count(w) for w in UP), sum(low.count(w) for w in DOWN)
            total = up + down + 1.0
            out.append((down / total, 1.0 / total, up / total))
        return out

    return score


def predict(inputs: DataFrame, make_scorer: Callable[[], Scorer] = lexicon_scorer, batch: int = 32) -> DataFrame:
    """Predictions of (id, model_input); a null input is an empty text. The first of equal labels counts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make_scorer()
        for rows in it:
            ids, texts = rows.column(0).to_pylist(), [t or "" for t in rows.column(1).to_pylist()]
            probs = [p for k in range(0, len(texts), batch) for p in scorer(texts[k : k + batch])]
            best = [max(range(3), key=lambda j, p=p: p[j]) for p in probs]
            cols = [pa.array(ids, pa.string()), pa.array([LABELS[b] for b in best], pa.string()), pa.array([p[2] - p[0] for p in probs], pa.float64()), pa.array([max(p) for p in probs], pa.float64())]
            cols += [pa.array([p[j] for p in probs], pa.float64()) for j in range(3)]
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in SCHEMA.split(", ")])

    return inputs.select("id", "model_input").mapInArrow(run, SCHEMA)
