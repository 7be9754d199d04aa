"""States of batches against the full run."""

import random

from scorefold.operators import feature_state, scores
from scorefold.operators.feature_state import merge_states, read_state, score_state, state_features, update_state

SCHEMA = "ma_sv int, ma_mon string, diem double, version int"


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_any_split_gives_the_same_state(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(30), f"m{rng.randrange(9)}", rng.choice([None, 10.5, rng.randrange(101) / 10]), 1) for _ in range(900)]
    whole = spark.createDataFrame(rows, SCHEMA)
    parts = [spark.createDataFrame(rows[i::4], SCHEMA) for i in range(4)]
    merged = merge_states(*[score_state(p) for p in parts])
    assert plain(merged) == plain(score_state(whole))
    # what was added can be taken off
    assert plain(merge_states(merged, score_state(parts[0], -1))) == plain(merge_states(*[score_state(p) for p in parts[1:]]))
    got = {r.ma_sv: r for r in state_features(merged).collect()}
    for r in scores.student_features(whole).collect():
        own = got[r.ma_sv]
        assert (own.gpa, own.failed_subjects, own.excellent_subjects) == (r.gpa, r.failed_subjects, r.excellent_subjects) and abs(own.std_score - r.std_score) < 1e-12


def test_late_corrected_and_repeated_batches(spark, tmp_path):
    path = str(tmp_path / "state")
    batches = [
        [(1, "a", 5.0, 2), (1, "b", 9.0, 2), (2, "a", None, 1), (None, "a", 7.0, 1), (1, "a", 4.0, 1)],
        [(1, "a", 8.0, 1), (2, "a", 6.0, 2), (3, "c", 10.0, 1), (None, "a", 1.0, 9)],  # late, corrected, new
        [(1, "b", 2.0, 3), (1, "b", 3.0, 3)],  # of equal versions the greater score
        [],
    ]
    for batch in batches:
        update_state(spark, path, spark.createDataFrame(batch, SCHEMA))
    last = {(1, "a"): 5.0, (1, "b"): 3.0, (2, "a"): 6.0, (None, "a"): 1.0, (3, "c"): 10.0}
    full = score_state(spark.createDataFrame([(s, m, x, 1) for (s, m), x in last.items()], SCHEMA))
    before = plain(read_state(spark, path))
    assert before == plain(full)
    update_state(spark, path, spark.createDataFrame(batches[1], SCHEMA))
    assert plain(read_state(spark, path)) == before and len(before) == 4
    assert feature_state.state_features(read_state(spark, path)).where("ma_sv = 3").first().std_score == 0.0
