import random

import pytest
from edge import docs_frame, odd_texts

from pitlane.llm import decontaminate, queries
from pitlane.llm.decontaminate import contaminated, drop_contaminated, template_words

ITEMS = ["If Anna walks 12 km in 3 hours and then rests for 20 minutes, how far does Anna walk in 9 hours at the same speed?",
         "what colour is the deep sea", "too short", None, "", "The quick reading of a long benchmark passage, which nobody should see in training, ends here."]


def items_frame(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    pad = lambda n: " ".join(f"pad{rng.choice('abcdefghij')}{rng.choice('xyz')}" for _ in range(n))
    return {
        "exact": f"{pad(20)}. {ITEMS[0]} {pad(5)}",
        "changed": f"{pad(9)}.\n{ITEMS[0].replace('Anna', 'Boris').replace('12', '1,250.5').replace('km', 'miles').replace('9', '44')}",
        "inconsistent": f"{pad(9)}. If Anna walks 12 km in 3 days and then rests for 20 minutes, how far does Anna walk in 9 hours at the same speed?",
        "short": f"{pad(4)} What colour is the deep sea? {pad(4)}",
        "half": f"{pad(3)} of a long benchmark passage, which nobody should see in {pad(30)}",
        "little": f"{pad(3)} of a long benchmark passage {pad(30)}",
        "two": f"{ITEMS[5]}\n{pad(3)}\n{ITEMS[1]}",
        "clean": pad(500), "too short": "too short", "numbers": " ".join(str(i) for i in range(50)),
    }


def test_templates_and_slots(spark, texts):
    names = list(texts)
    df = docs_frame(spark, enumerate(texts.values()))
    got = {(names[r.doc_id], r.item_id): r for r in contaminated(df, "doc_id", "text", items_frame(spark, ITEMS), "item_id", "text").collect()}
    # "inconsistent" holds 17 words in a row as they stand beside the value that clashes
    assert set(got) == {("exact", 0), ("changed", 0), ("inconsistent", 0), ("short", 1), ("half", 5), ("two", 5), ("two", 1)}
    assert {k for k, r in got.items() if r.changed} == {("changed", 0)}
    assert got["exact", 0].covered >= got["exact", 0].item_words - 2


def test_shuffled_join_gives_the_same(spark, texts, monkeypatch):
    df, items = docs_frame(spark, enumerate(texts.values())), items_frame(spark, ITEMS)
    want = sorted(map(str, contaminated(df, "doc_id", "text", items, "item_id", "text").collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(str, contaminated(df, "doc_id", "text", items, "item_id", "text").collect())) == want


def test_edges(spark):
    rows = list(enumerate(odd_texts())) + [(None, ITEMS[0]), (90, ITEMS[0]), (90, ITEMS[0])]
    df, items = docs_frame(spark, rows), items_frame(spark, ITEMS)
    got = contaminated(df, "doc_id", "text", items, "item_id", "text").collect()
    assert sorted(str(r.doc_id) for r in got) == ["90", "90", "None"]
    kept = drop_contaminated(df, "doc_id", "text", items, "item_id", "text")
    assert kept.columns == df.columns and kept.count() == len(rows) - 2
    assert contaminated(df, "doc_id", "text", items.limit(0), "item_id", "text").count() == 0
    assert contaminated(df.limit(0), "doc_id", "text", items, "item_id", "text").count() == 0


def test_query_against_brute_force(spark):
    """The benchmark here has no numbers or names, so templates are lower-cased words."""
    words = lambda name, key: [(r[0], r[1]) for r in spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").select(key, template_words("text")).collect()]
    strip = lambda ws: [w[:2] if w[0] == "\x01" else w for w in ws]
    docs, items = words("documents", "doc_id"), words("benchmark", "item_id")
    at = {}
    for i, w in items:
        w = strip(w)
        for k in range(len(w) - 7):
            at.setdefault(tuple(w[k: k + 8]), []).append((i, k))
    size = {i: len(w) for i, w in items}
    want = set()
    for doc, w in docs:
        w, found = strip(w), {}
        for k in range(len(w) - 7):
            for i, p in at.get(tuple(w[k: k + 8]), ()):
                found.setdefault(i, {}).setdefault(k - p, set()).update(range(p, p + 8))
        for i, diags in found.items():
            runs = []
            for places in diags.values():
                run = 0
                for p in range(size[i] + 1):
                    run = run + 1 if p in places else 0
                    runs.append(run)
            if len(set().union(*diags.values())) >= size[i] / 2 or max(runs) >= 13:
                want.add((doc, i))
    got = {(r.doc_id, r.item_id) for r in queries.op2_decontamination(spark, "/root/testdata/sf0.01").collect()}
    assert got == want and len(got) > 5


def test_copies_without_the_capitals(spark):
    """A name in every 8 words: nothing is found unless names are also compared as words."""
    item = "When Anna met Boris near Paris with Clara and Dmitri the old friends asked Emma whether Felix knew how Greta lost."
    texts = [item, item.lower(), item.upper(), item.replace(" Boris", "\nBoris").replace(" Dmitri", "  Dmitri").replace(" Felix", "\nFelix"), item.title(),
             item.replace("Anna", "Olga").replace("Boris", "Peter"), "when anna met someone near a town with other people and then went away"]
    for a, b in ((item, texts), (item.lower(), texts[:5])):
        got = contaminated(docs_frame(spark, enumerate(b)), "doc_id", "text", items_frame(spark, [a]), "item_id", "text").collect()
        assert {r.doc_id: r.changed for r in got} == {k: k == 5 for k in range(len(b)) if k != 6}


def test_values_against_brute_force(spark):
    """Items full of numbers and units; copies with values kept, changed alike, changed in one place, and cut short."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeghijnoqrsuwxz") for _ in range(5))
    value = lambda: str(rng.randrange(2, 7))
    unit = lambda: rng.choice(["km", "hours", "days"])
    items, docs = [], []
    for _ in range(12):
        items.append(" ".join(f"{word()} {word()} {word()} {word()} {value()} {unit()}" if rng.random() < .6 else " ".join(word() for _ in range(6)) for _ in range(rng.randrange(3, 9))))
    for k in range(240):
        w = items[k % 12].split()
        if k % 4 == 1:
            new = {v: str(rng.randrange(10, 99)) for v in "23456"}
            w = [new.get(x, x) for x in w]
        elif k % 4 >= 2:
            places = [i for i, x in enumerate(w) if x.isdigit() or x in ("km", "hours", "days")]
            for i in rng.sample(places, min(len(places), rng.randrange(1, 4))):
                w[i] = str(rng.randrange(10, 99)) if w[i].isdigit() else unit()
        if rng.random() < .4:
            at = rng.randrange(len(w))
            w = w[at:] + [word() for _ in range(3)] + w[:at]
        docs.append(" ".join([word(), word(), *w, word()]))
    templates = lambda texts: [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i long, t string").orderBy("i").select(template_words("t")).collect()]
    form = lambda w: w[:2] if w[0] == "\x01" else w
    iw, dw = templates(items), templates(docs)
    assert any(x.startswith("\x01u") for w in iw for x in w)
    want = {}
    for d, b in enumerate(dw):
        for i, a in enumerate(iw):
            diags = {}
            for p in range(len(a) - 7):
                if sum(x[0] != "\x01" for x in a[p: p + 8]) < 4:
                    continue
                for q in range(len(b) - 7):
                    if list(map(form, a[p: p + 8])) == list(map(form, b[q: q + 8])):
                        diags.setdefault(q - p, []).append((p, [(x, y) for x, y in zip(a[p: p + 8], b[q: q + 8]) if x[0] == "\x01"]))
            covered, run, changed = set(), 0, False
            for windows in diags.values():
                to = {}
                for _, slots in windows:
                    for x, y in slots:
                        to.setdefault(x, set()).add(y)
                good = [(p, slots) for p, slots in windows if all(x == y for x, y in slots) or all(len(to[x]) == 1 for x, _ in slots)]
                own = {p + j for p, _ in good for j in range(8)}
                covered |= own
                changed |= any(x != y for _, slots in good for x, y in slots)
                starts, first, end = sorted(p for p, _ in good), 0, -1
                for p in starts:
                    first = first if p <= end else p
                    end = p + 8
                    run = max(run, end - first)
            if len(covered) >= len(a) / 2 or run >= 13:
                want[d, i] = (len(covered), run, changed)
    got = {(r.doc_id, r.item_id): (r.covered, r.run, r.changed) for r in contaminated(docs_frame(spark, enumerate(docs)), "doc_id", "text", items_frame(spark, items), "item_id", "text").collect()}
    assert got == want and len({d for d, _ in got if d % 4 >= 2}) > 60 and any(c for *_, c in got.values())


def test_a_text_that_repeats_an_item(spark):
    got = contaminated(docs_frame(spark, [(1, "\n".join([ITEMS[0]] * 3_000))]), "doc_id", "text", items_frame(spark, ITEMS), "item_id", "text").collect()
    assert [(r.doc_id, r.item_id, r.changed) for r in got] == [(1, 0, False)]
