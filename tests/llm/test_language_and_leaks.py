"""Language identification by held-out accuracy; decontamination against a full edit distance."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import decontaminate, langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_und(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(10**6, None, "en"), (10**6 + 1, "", "de"), (10**6 + 2, "12 34 -- !", "fr"), (None, "the thing", None), (10**6 + 3, "word " * 60_000, None)]
    found = langid.identify_language(docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("language", F.lit(1)))
    rows = found.select("doc_id", "lang", "text", langid.held_out("doc_id").alias("held"), "language.*").collect()
    assert len(rows) == docs.count() + len(extra)
    held = [r for r in rows if r.held and r.lang and r.doc_id < 10**6]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    odd = [r for r in rows if r.doc_id in (10**6, 10**6 + 1, 10**6 + 2)]
    assert [(r.lang_pred, r.score, r.rejected) for r in odd] == [("und", 0.0, True)] * 3
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 4


def test_far_texts_are_rejected_and_nothing_to_learn_is_und(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    assert model.predict("Привет как дела сегодня хорошо")[2] and not model.predict("The thing and the other.")[2]
    empty = langid.fit(docs.where("false"))
    assert empty.predict("some words") == ("und", 0.0, True)
    assert langid.identify_language(docs.where("false")).collect() == []


def test_unlearnt_languages_of_the_same_script_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    unlearnt = [
        "Questa è una frase scritta in italiano per vedere se il modello la riconosce, perché gli uomini nascono tutti liberi ed eguali.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi.",
        "xkqj zvwp qqxz jjkv wwxq zzpk vkjx qpzw xxjq kkvz pqzx jwvk",
    ]
    assert all(model.predict(t)[2] for t in unlearnt)
    held = [r.text for r in docs.where(langid.held_out("doc_id")).collect() if langid.counts(r.text) is not None]
    assert np.mean([model.predict(t)[2] for t in held]) < 0.01


def test_a_language_of_copies_is_learnt_from_its_distinct_texts(spark):
    draw = random.Random(5)

    def prose(syllables):
        return " ".join("".join(draw.choice(syllables) for _ in range(draw.randint(1, 3))) for _ in range(20))

    rare = [prose(["ko", "mi", "ta", "ru", "ne"]) for _ in range(12)]
    usual = [(prose(["the", "er", "ing", "on", "st"]), "xx") for _ in range(60)]
    copied = [(t, "yy") for t in rare for _ in range(100 if t != rare[0] else 400)]
    docs = spark.createDataFrame(usual + copied, "text string, lang string")
    model = langid.fit(docs, sample=6)
    assert model.labels == ["xx", "yy"] and model.predict(prose(["ko", "mi", "ta", "ru", "ne"]))[0] == "yy"
    total = len(usual) + len(copied)
    slots = [set(np.concatenate(list(langid._slots(langid._letters(t)))).tolist()) for t, _ in usual + copied]
    for slot in (s for s in slots[0] | slots[-1] if s % 5 == 0):
        want = np.log((total + 1) / (sum(slot in s for s in slots) + 1)) + 0.1
        assert model.idf[slot] == pytest.approx(want, rel=1e-4)


def full_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
    return min(row)


@pytest.mark.parametrize("seed", range(4))
def test_leaks_equal_full_edit_distance(seed):
    draw = random.Random(seed)
    syllables = ["the", "an", "tion", "er", "ou", "st", "on", "ing"]

    def prose(n):
        return " ".join("".join(draw.choice(syllables) for _ in range(draw.randint(1, 3))) for _ in range(n))

    items = [(i, prose(draw.randint(8, 30))) for i in range(12)]
    index = decontaminate.build_index(items, 8, 0.08)
    for _ in range(25):
        item = list(draw.choice(items)[1])
        for _ in range(draw.randint(0, int(0.13 * len(item)))):
            at = draw.randrange(len(item))
            item[at : at + 1] = draw.choice([[], ["z"], [item[at], "q"]])
        text = f"{prose(draw.randint(0, 20))} {''.join(item)} {prose(draw.randint(0, 20))}".strip()
        found = {i: edits for i, _, edits in decontaminate.find(text, index, 8)}
        want = {i: d for i, t in items if (d := full_distance(t, text)) <= int(0.08 * len(t))}
        assert found == want


def test_contamination_edge_cases(spark):
    long = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do"
    items = spark.createDataFrame([(1, long), (2, None), (3, "..."), (4, "tiny"), (4, long.upper()), (None, "another passage of some words here")], "item_id long, text string")
    rows = [(1, f"xx {long.replace(' ', chr(10))}! yy"), (1, f"xx {long} yy"), (2, None), (3, ""), (4, "a tiny thing"), (5, "tinyness"), (None, "w " * 50_000 + long), (6, "Another passage, of some words here.")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, leaks string")
    found = decontaminate.find_contamination(docs, items, block_chars=70).collect()
    got = sorted((str(r.doc_id), sorted(str(x.item_id) for x in r.leaks)) for r in found)
    assert got == sorted([("1", ["1", "4"]), ("1", ["1", "4"]), ("2", []), ("3", []), ("4", ["4"]), ("5", []), ("None", ["1", "4"]), ("6", ["None"])])
    assert all(not r.leaks for r in decontaminate.find_contamination(docs, items.where("false")).collect())
    assert decontaminate.find_contamination(docs.where("false"), items).collect() == []


@pytest.mark.parametrize("n", [8, 9, 12, 13, 14, 15, 16, 24, 25, 26])
def test_short_items_with_all_the_edits_they_may_have(n):
    item = "qwertyuiopasdfghjklzxcvbnm"[:n]
    index = decontaminate.build_index([(1, item)], 8, 0.08)
    budget = int(0.08 * n)
    spread = list(item)
    for k in range(budget):
        spread[(k + 1) * n // (budget + 1)] = "9"
    assert decontaminate.find(f"some words {''.join(spread)} and more", index, 8) == [(1, 11 + n, budget)]
    assert full_distance(item, "".join(spread)) == budget
    if budget == 1:
        for at in range(n):
            text = f"some words {item[:at]}9{item[at + 1 :]} and more"
            assert [(i, e) for i, _, e in decontaminate.find(text, index, 8)] == [(1, full_distance(item, text))]


def test_long_items_are_found_by_their_passages():
    draw = random.Random(6)
    item = " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(60))
    index = decontaminate.build_index([(1, item), (2, "something else that is long enough")], 8, 0.08)
    for start in (0, 7, int(0.15 * len(item))):
        quote = item[start : start + int(0.85 * len(item))]
        assert [(i, e) for i, _, e in decontaminate.find(f"before {quote} after", index, 8)] == [(1, 0)]
        edited = "".join("9" if k % 20 == 3 else c for k, c in enumerate(quote))
        ((found, _, edits),) = decontaminate.find(f"before {edited} after", index, 8)
        assert found == 1 and 0 < edits <= int(0.08 * decontaminate.PASSAGE)
    assert decontaminate.find(f"before {item[:150]} after", index, 8) == []


def test_two_blocks_equal_one(spark):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 300")
    def leaks(**options):
        return sorted((r.doc_id, sorted(map(tuple, r.leaks))) for r in decontaminate.find_contamination(docs, benchmark, **options).collect())

    one = leaks()
    assert sum(bool(found) for _, found in one) > 3
    assert leaks(block_chars=20_000) == one
