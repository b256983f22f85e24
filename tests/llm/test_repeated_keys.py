"""Near-dedup keeps a row of every class, however keys repeat."""

from collections import Counter

from opspulse.llm import neardup


def words(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_unlike_texts_of_one_key_keep_a_row_each(spark):
    a, b, c = words("a"), words("b"), words("c")
    near = a + " more"
    rows = [(1, a, "x"), (1, b, "y"), (2, near, "z"), (2, c, "u"), (3, c, "v"), (1, a, "w"), (4, None, "n"), (5, "", "m"), (None, a, "k"), (None, a, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, c string")
    kept = [tuple(r) for r in neardup.deduplicated(docs).collect()]
    assert Counter((k, t) for k, t, _ in kept) == Counter([(1, a), (1, b), (2, c), (4, None), (None, a), (None, a)])
    again = [tuple(r) for r in neardup.deduplicated(docs.repartition(3)).collect()]
    assert Counter(again) == Counter(kept)  # the row that stays does not depend on the order


def test_planted_near_copies_are_found(spark):
    r = __import__("random").Random(7)
    base = [[f"w{r.randrange(5000)}" for _ in range(200)] for _ in range(60)]
    rows = []
    for i, text in enumerate(base):
        rows.append((3 * i, " ".join(text)))
        rows.append((3 * i + 1, " ".join(text[:190])))  # 186 of 196 shingles
        rows.append((3 * i + 2, " ".join(text[:100] + ["other"] + text[101:])))  # 191 of 201
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in neardup.near_duplicate_classes(docs).collect()}
    found = sum(got[3 * i + j] == 3 * i for i in range(60) for j in (1, 2))
    print(f"recall on planted pairs: {found / 120:.3f}")
    assert found >= 0.9 * 120 and {x % 3 for x in got.values()} == {0} and len(set(got.values())) == 60
