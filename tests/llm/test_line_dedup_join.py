"""Line dedup's join: sizes at the limit of what may match, and what is left out of it."""

import random

import pytest

from ledgerlake.llm import line_dedup


def brute_force(texts, threshold):
    lines = [(i, k, frozenset(x.split())) for i, t in enumerate(texts) for k, x in enumerate(t.split("\n"))]
    return {(i, k) for a, (i, k, w) in enumerate(lines)
            if any(100 * len(w & v) >= threshold * len(w | v) for _, _, v in lines[:a])}


def removed(rows):
    return {(r.doc_id, x) for r in rows for x in r.removed_lines}


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("threshold", [60, 80])
def test_lines_of_unlike_sizes(spark, threshold):
    """Pairs whose sizes lie at, and just beyond, the ratio that may still match,
    the smaller line first or last; the words in common are the more frequent ones."""
    texts = []
    for i, n in enumerate((2, 4, 5, 8, 16, 20, 40, 72, 90, 100, 180)):
        few = [f"c{k}" for k in range(n)]
        for j, more in enumerate((100 * n // threshold, 100 * n // threshold + 1, n + 1)):
            many = few + [f"x{i}y{j}z{k}" for k in range(more - n)]
            swapped = [*few[: n - n // 10], *(f"s{i}t{j}u{k}" for k in range(n // 10))]
            three = [" ".join([*w, f"p{i}q{j}"]) for w in (few, many, swapped)]
            texts.append("\n".join(three if (i + j) % 2 else three[::-1]))
    got = line_dedup.per_document(table(spark, texts), threshold=threshold).collect()
    assert removed(got) == brute_force(texts, threshold)


def test_lone_keys_and_undecided_sets_are_not_shuffled(spark, monkeypatch):
    """Sets that share no key with another have no leaders, and sets that were not
    decided are not held against the decided ones; equal rows count once."""
    rows, written = {}, line_dedup.written

    def counted(df, name, **how):
        out = written(df, name, **how)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "written", counted)
    rng = random.Random(11)
    texts = [" ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 9999)}" for _ in range(30)) for _ in range(200)]
    texts += [f"{x} again{i}" for i, x in enumerate(texts[:5])]
    d = table(spark, texts)
    got = line_dedup.per_document(d.unionByName(d)).collect()
    assert removed(got) == brute_force(texts, 80) and len(removed(got)) == 5
    assert len(got) == len(texts) and {r.n_lines for r in got} == {1}
    assert rows["line-sets"] == [205]
    assert rows["line-heads"][0] < 50 and rows["line-decided"][0] < 20 and "flagged-sets" not in rows
