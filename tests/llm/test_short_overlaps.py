"""Verbatim short items and verbatim passages of long ones."""

import numpy as np

from barsmith.llm import decontaminate


def test_short_items_and_unbroken_passages(spark):
    noise = [f"u{i}" for i in range(100)]
    items = {k: [f"i{k}w{i}" for i in range(k)] for k in (4, 5, 6, 7, 8, 60)}
    long = items[60]
    docs = {k: noise[:30] + w + noise[30:] for k, w in items.items() if k < 60}
    docs |= {13: noise + long[20:33], 24: noise + long[:24] + noise, 12: noise + long[20:32],
             106: noise + items[6][:5], 107: noise + items[7][:6]}

    def frame(table, key):
        return spark.createDataFrame([(k, " ".join(w)) for k, w in table.items()], f"{key} long, text string")

    found = decontaminate.overlaps(frame(docs, "doc_id"), frame(items, "item_id")).collect()
    assert {(r.doc_id, r.item_id, r.equal_words) for r in found} == \
        {(5, 5, 5), (6, 6, 6), (7, 7, 7), (8, 8, 8), (13, 60, 13), (24, 60, 24)}


def test_longest_copy():
    for text, want in (("", 0), ("0", 0), ("1", 1), ("0110111", 3), ("1110110", 3)):
        assert decontaminate.longest_copy(np.array([c == "1" for c in text], bool)) == want
