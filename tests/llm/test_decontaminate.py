import random

from partwise.llm.decontaminate import ITEMS_PER_BLOCK, _masks, common_subsequence, find_contamination, words
from partwise.llm.queries import op4_decontamination
from partwise.llm.tables import read

import numpy as np


def test_whole_table(spark, sf_dir):
    """Every verbatim passage is found, and nothing in which no item lies word for word."""
    docs = read(spark, sf_dir, "documents").collect()
    items = read(spark, sf_dir, "benchmark").collect()
    flat = {d["doc_id"]: b" " + b" ".join(words(d["text"])) + b" " for d in docs}
    wanted = {(d, i["item_id"]) for i in items for d, t in flat.items() if b" " + b" ".join(words(i["text"])) + b" " in t}
    found = op4_decontamination(spark, sf_dir).collect()
    assert wanted and {(r["doc_id"], r["item_id"]) for r in found} == wanted


def caught(item, text):
    """What the docstring promises: a near-verbatim copy, or half of the words and of the answer's."""
    a, b = words(item), words(text)
    number = {w: i for i, w in enumerate({*a, *b})}
    similar = common_subsequence(_masks(np.array([number[w] for w in a], np.int32)), len(a), [number[w] for w in b]) / len(a)
    answer = set(words(item.rstrip(".").rsplit(". ", 1)[-1]))
    return similar >= 0.8 or similar >= 0.5 and len(answer & set(b)) >= len(answer) / 2


def test_paraphrases_and_edges(spark):
    rng = random.Random(3)
    say = lambda n: [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(n)]
    items = [(i, " ".join(say(n)) + ". " + " ".join(say(4)) + ".") for i, n in enumerate((20, 40, 70, 15, 30))]
    items += [(5, "only three words"), (6, None), (7, ""), (None, "no id at all")]

    def changed(text, share):
        return " ".join(f"new{rng.randrange(99)}" if rng.random() < share else w for w in text.split())

    docs, wanted = [], set()
    for d in range(40):
        i = d % 5
        text = items[i][1] if d < 20 else changed(items[i][1], 0.12)
        docs.append((d, " ".join([*say(rng.randrange(0, 300)), text.upper() if d % 3 else text, *say(rng.randrange(0, 300))])))
        if caught(items[i][1], text):
            wanted.add((d, i))
    assert len(wanted) > 30
    docs += [(100 + d, " ".join(say(200))) for d in range(40)]
    docs += [(200, None), (201, ""), (202, " ".join(say(60_000)) + " only, three WORDS " + items[0][1]), (203, "three only words"), docs[0]]
    wanted |= {(202, 5), (202, 0)}
    schema = "doc_id long, text string"
    table = spark.createDataFrame(docs, schema).selectExpr("*", "1 as terms", "2 as similarity", "3 as id")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = [(r["doc_id"], r["item_id"]) for r in find_contamination(table, bench).collect()]
    assert len(found) == len(set(found)) and set(found) == wanted
    assert find_contamination(table.limit(0), bench).count() == 0
    assert find_contamination(table, bench.limit(0)).count() == 0


def test_a_paraphrase_needs_the_answer(spark):
    words_ = [f"q{i}" for i in range(30)]
    text = " ".join(w if i % 3 else f"z{i}" for i, w in enumerate(words_))  # two thirds in order
    rng = random.Random(4)
    other = [(10 + d, " ".join(f"q{rng.randrange(900)}" for _ in range(60))) for d in range(300)]
    docs = spark.createDataFrame([(1, text + " gold ring"), (2, text + " iron bar"), *other], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(words_), "gold ring")], "item_id long, text string, answer string")
    assert [r["doc_id"] for r in find_contamination(docs, bench, answer_col="answer").collect()] == [1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(0, 30))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        assert common_subsequence(_masks(np.array(a, np.int32)), len(a), b) == row[-1]


def test_recall_with_a_full_block(spark):
    """Of the paraphrases that the rule counts, among as many items as a block holds."""
    rng = random.Random(7)
    say = lambda n: [f"w{int(4000 * rng.random() ** 3)}" for _ in range(n)]
    items = [(i, " ".join(say(rng.randrange(12, 56))) + ". " + " ".join(say(4)) + ".") for i in range(ITEMS_PER_BLOCK)]
    docs, wanted = [], set()
    for d in range(300):
        i, keep = rng.randrange(len(items)), rng.choice((0.9, 0.7, 0.6))
        body, answer = items[i][1][:-1].rsplit(". ", 1)
        text = " ".join(w if rng.random() < keep else say(1)[0] for w in body.split()) + " " + answer
        docs.append((d, " ".join([*say(rng.randrange(0, 120)), text, *say(rng.randrange(0, 120))])))
        if caught(items[i][1], text):
            wanted.add((d, i))
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_contamination(docs, bench).collect()}
    assert len(wanted) > 250
    lost = len(wanted - found) / len(wanted)
    assert lost <= 0.01, (lost, len(wanted), len(found))
