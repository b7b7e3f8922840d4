"""Contexts that cannot hold a repeat are not sorted, and no repeat is lost."""

import numpy as np


def test_contexts_without_a_repeat_are_not_sorted():
    from carestrata.llm import suffix

    rng = np.random.default_rng(5)
    gram = bytes(rng.integers(0, 256, suffix.GRAM, dtype=np.uint8))
    some = lambda n: bytes(rng.integers(0, 256, n, dtype=np.uint8))
    key = int(suffix._hashes(suffix._sums(np.frombuffer(gram, dtype=np.uint8)), suffix.GRAM, 0)[0].astype(np.int64))
    left, right = some(84), some(84)
    sets = [
        [some(100) + gram + some(100), some(90) + gram + some(120), some(168) + gram],  # only the short string is shared
        [some(9) + left + gram + right + some(9), some(9) + left + gram + right + some(7), some(90) + gram + some(90)],
        [left + gram + right[:40] + left + gram + right[:40] + some(60), some(84) + gram + some(84)],
    ]
    may = suffix.possible_repeats([key] * 3, sets)
    assert may == [[False] * 3, [True, True, False], [True, False]]
    for strings, flags, found in zip(sets, may, suffix.repeated_windows(sets)):
        for s, m, starts in zip(strings, flags, found):
            windows = [t[i : i + 200] for t in strings for i in range(len(t) - 199)]
            assert starts.tolist() == [i for i in range(len(s) - 199) if windows.count(s[i : i + 200]) > 1]
            assert m or not len(starts)


def test_sets_of_one_key_are_filtered_before_the_sort(spark):
    from carestrata.llm import suffix

    shared = " ".join(f"word{i}" for i in range(60))
    texts = [f"{i} {shared} {i}" for i in range(4)] + ["x" * 700, " ".join(f"own{i * i}" for i in range(90))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_removed"] for r in suffix.remove_repeats(docs).collect()}
    for i, t in enumerate(texts):
        everywhere = [u[k : k + 200] for u in texts for k in range(len(u) - 199)]
        hit = {j for k in range(len(t) - 199) if everywhere.count(t[k : k + 200]) > 1 for j in range(k, k + 200)}
        assert found[i] == len(hit)
