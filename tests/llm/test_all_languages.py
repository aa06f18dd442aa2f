"""Languages beyond the 64 most frequent are learned too."""

import random

from barsmith.llm import langid


def test_seventy_languages(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    pairs = random.Random(5).sample([a + b for a in letters for b in letters], 210)
    docs = []
    for k in range(70):
        words = ["".join(p) * 2 for p in (pairs[3 * k], pairs[3 * k + 1], pairs[3 * k + 2])]
        for n in range(4 if k < 64 else 3):
            draw = random.Random(100 * k + n)
            docs.append((len(docs), " ".join(draw.choices(words, k=20)), f"l{k:02}"))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(df, "doc_id", "text", "lang", langid.Settings(rounds=5))
    assert sorted(model.languages) == [f"only l{k:02}" for k in range(70)]
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()}
    assert got == {i: lang for i, _, lang in docs}
