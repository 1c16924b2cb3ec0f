import random

import pyarrow as pa
import pytest

from firmloom.functions.similarity import combined_score, match_status, token_set_ratio, token_sort_ratio


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def slow_ratio(a, b):
    total = len(a) + len(b)
    return 100.0 if not total else 100 * (1 - (total - 2 * slow_lcs(a, b)) / total)


def slow_sort(a, b):
    return slow_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def slow_set(a, b):
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both, x, y = (" ".join(sorted(s)) for s in (left & right, left - right, right - left))
    if both and (not x or not y):
        return 100.0
    with_x, with_y = (both + " " + x).strip(), (both + " " + y).strip()
    whole = 100 * (1 - (len(x) + len(y) - 2 * slow_lcs(x, y)) / (len(with_x) + len(with_y)))
    return max([whole] + ([slow_ratio(both, with_x), slow_ratio(both, with_y)] if both else []))


@pytest.mark.parametrize("alphabet, longest", [("ab", 200), ("ab é½𝐀", 150), ("a", 130), ("abcdefghij k", 70)])
def test_lcs_against_brute_force(spark, alphabet, longest):
    from firmloom.functions.lcs import lcs_of_pairs

    rng = random.Random(longest)
    texts = [
        ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(120)]
        for _ in range(2)
    ]
    left, right = map(pa.array, texts)
    want = [slow_lcs(a, b) for a, b in zip(*texts)]
    assert list(lcs_of_pairs(left, right)) == want
    assert list(lcs_of_pairs(left[7:90], right[7:90])) == want[7:90]


def test_token_scores_against_brute_force(spark):
    rng = random.Random(3)
    words = ["red", "blue", "bolt", "bolts", "rod", "a", "x1", "international"]
    pairs = [("", ""), ("a", ""), ("b a", "a b"), ("a b c", "a b"), ("x", "y")]
    pairs += [
        tuple(" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(2))
        for _ in range(300)
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    rows = df.orderBy("i").select(
        token_sort_ratio("a", "b"), token_set_ratio("a", "b"), combined_score("a", "b"),
        token_sort_ratio("b", "a"), token_set_ratio("b", "a"),
    ).collect()
    for (a, b), row in zip(pairs, rows):
        assert row[0] == pytest.approx(slow_sort(a, b)) == pytest.approx(row[3])
        assert row[1] == pytest.approx(slow_set(a, b)) == pytest.approx(row[4])
        assert row[2] == max(row[0], row[1]) and 0 <= row[2] <= 100


def test_match_status(spark):
    df = spark.createDataFrame([(None,), (84.999,), (85.0,), (94.999,), (95.0,)], "s double")
    got = [r[0] for r in df.select(match_status("s")).collect()]
    assert got == ["unmatched", "unmatched", "review", "review", "auto"]
