from collections import Counter

from ledgerlift.llm import decontaminate as D

ITEMS = [
    (1, "Anna has 12 apples and gives 5 apples to her friend Boris before she walks 3 km home. "
        "How many apples does Anna have left at home?"),
    (2, "the quick onder of things that never was said before in any book that people read at night"),
    (3, "short item of six plain words"),
    (4, None), (5, ""), (None, "a question without an id that still is a question for all of the models here"),
    (6, "12 34 56 78 90 11 12 13"),
]


def run(spark, texts, items=ITEMS):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    return sorted(((r.doc_id, r.item_id) for r in D.contaminated_documents(docs, bench).collect()), key=str)


def test_reparameterised_questions(spark):
    text = ITEMS[0][1]
    other = text.replace("Anna", "Clara").replace("Boris", "Dmitri").replace("12", "31").replace(" 5 ", " 17 ").replace("km", "miles")
    mixed = text.replace("has 12", "has 31").replace("Anna have", "Clara have")
    texts = [text, "Before. " + other + " After.", text.upper().lower(), "Nothing of the kind is here, 12 apples or not.",
             " ".join(text.split()[:9]), ITEMS[1][1].replace(" ", "\n- "), "say: short item of six plain words!",
             "short item of six other words", ITEMS[5][1], None, "", "12 34 56 78 90 11 12 13"]
    got = run(spark, texts)
    for doc in (0, 1):
        assert (doc, 1) in got
    assert (5, 2) in got and (6, 3) in got and (8, None) in got
    assert (11, 6) in got  # a verbatim copy needs no plain words
    assert not {3, 4, 7, 9, 10} & {d for d, _ in got}
    assert mixed != text


def test_slots_must_be_consistent(spark):
    item = [(1, "A train covers 40 miles and then it covers 40 miles again on the line home")]
    good = "A train covers 70 miles and then it covers 70 miles again on the line home"
    bad = "A train covers 70 miles and then it covers 80 miles again on the line home"
    assert run(spark, [good, bad], item) == [(0, 1)]


def test_tables_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: r.text.lower().split() for r in bench.collect()}
    grams = {}
    for i, w in items.items():
        for j in range(len(w) - 7):
            grams.setdefault(tuple(w[j:j + 8]), set()).add((i, j))
    want = set()
    for r in docs.select("doc_id", "text").collect():
        w, runs = (r.text or "").lower().split(), Counter()
        for p in range(len(w) - 7):
            for i, j in grams.get(tuple(w[p:p + 8]), ()):
                runs[i, p - j] += 1
        want |= {(r.doc_id, i) for (i, _), n in runs.items() if n + 7 >= 13}
    got = {(r.doc_id, r.item_id) for r in D.contaminated_documents(docs, bench).collect()}
    assert got == want and want


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "w " * 3)], "item_id long, text string")
    assert D.contaminated_documents(edge_docs, bench).collect() == []
    assert D.contaminated_documents(no_docs, bench).collect() == []
    assert D.contaminated_documents(edge_docs, bench.limit(0)).collect() == []
    assert D.clean_documents(edge_docs, bench).count() == edge_docs.count()
    text = next(r.text for r in edge_docs.filter("doc_id = 6").collect())
    hit = spark.createDataFrame([(9, " ".join(text.split()[10:60]))], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in D.contaminated_documents(edge_docs, hit).collect())
    bad = {d for d, _ in got}
    assert {6, 7, 8, 9, 10, None} == bad and max(got.values()) == 1
    kept = D.clean_documents(edge_docs, hit)
    assert kept.columns == edge_docs.columns
    # of the rows with id 7 or none, only those with the passage go
    left = Counter(r.doc_id for r in kept.collect())
    assert left[7] == 1 and left[None] == 2 and not left[6]


def test_verbatim_windows_poor_in_plain_words(spark):
    """Numbers, names and units: found word for word, not with other values."""
    item = [(1, "Paris 12 km, Rome 34 km, Anna 5 kg, Boris 7 kg, Oslo 9"), (2, "7 + 8 = 15 and 9 + 6 = 15 and 4 + 11 = 15"),
            (3, "Maria 3 Laura 4 Kevin 5")]
    texts = ["The table: Paris 12 km, Rome 34 km, Anna 5 kg, Boris 7 kg, Oslo 9", "see 7 + 8 = 15 and 9 + 6 = 15 and 4 + 11 = 15 here",
             "of Maria 3 Laura 4 Kevin 5 at", "The table: Paris 13 km, Rome 35 km, Anna 6 kg, Boris 8 kg, Oslo 10",
             "see 1 + 8 = 9 and 2 + 6 = 8 and 3 + 11 = 14 here"]
    assert run(spark, texts, item) == [(0, 1), (1, 2), (2, 3)]


def test_verbatim_copies_do_not_depend_on_their_surroundings(spark):
    item = [(1, "Which planet of the solar system has the most moons around it today?"),
            (2, "Name the largest city of northern Ontario now"),
            (3, "the old clock in the hall was wound by Peter every Sunday before Maria came down for tea and bread")]
    words = item[2][1].split()
    texts = ["the teacher asked Which planet of the solar system has the most moons around it today",
             "he said Name the largest city of northern Ontario now and left",
             item[2][1].lower().replace(" ", "\n"), " ".join([*words[:9], "always", *words[9:]]),
             " ".join([*words[:9], *words[10:]]), " ".join(words[:8]), "name the biggest city of northern ontario now"]
    assert run(spark, texts, item) == [(0, 1), (1, 2), (2, 3), (3, 3), (4, 3)]


def test_pieces_on_two_diagonals_need_the_same_slots(spark):
    item = [(1, "a train covers 40 miles of open country and later it covers 40 miles again on the line home")]
    piece = "a train covers 70 miles of open country and yes later it covers {} miles again on the line home"
    assert run(spark, [piece.format(70), piece.format(80)], item) == [(0, 1)]


def test_items_of_few_tokens(spark):
    """Found word for word and as a whole, once a document; nothing less than the whole item."""
    item = [(1, "Blue Danube waltz"), (2, "photosynthesis"), (3, "Who wrote Hamlet?"), (4, "?!"), (5, "a b c d"),
            (6, "12 km")]
    texts = ["They played the blue danube waltz and once more the Blue Danube Waltz.", "blue danube, but no dance",
             "Photosynthesis! photosynthesis " * 50, "asked who wrote Hamlet? then", "a b c x d", "over 12 km today", "13 km", "?!", None]
    assert run(spark, texts, item) == [(0, 1), (2, 2), (3, 3), (5, 6)]


def test_filter_grows_with_the_benchmark():
    import numpy as np

    sizes = [D.filter_bytes(n) for n in (0, 1000, 10 ** 6, 3 * 10 ** 6, 10 ** 12)]
    assert sizes == [1 << 21, 1 << 21, 1 << 21, 1 << 23, 1 << 24]
    rnd = np.random.default_rng(1)
    key = rnd.integers(0, 1 << 63, 200_000, np.uint64) * np.uint64(2) + np.uint64(1)
    for size in (1 << 21, 1 << 23):
        packed = np.zeros(8 * size, bool)
        for place in D.filter_places(key[:100_000], size):
            assert place.min() >= 0 and place.max() < 8 * size
            packed[place] = True
        bits = np.packbits(packed, bitorder="little")
        assert D.filter_has(bits, key[:100_000]).all()
        assert D.filter_has(bits, key[100_000:]).mean() < 0.01
