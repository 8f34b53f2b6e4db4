import random
import zlib

from ratevane.llm import toxicity as T


def corpus(rng, n):
    vocabulary = ["the", "and", "ing", "ther", "ation", "house", "green", "water", "letter", "number", "silent", "market"] + [f"{a}{b}" for a in ("st", "ra", "mo", "li") for b in ("ne", "der", "ver", "tion", "ble")]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(10, 60))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["moron", "idiot", "scumbag"])
        docs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_and_disguised(spark):
    docs, labels = corpus(random.Random(1), 1500)
    own = ["the m0r0n and", "an i d i o t here", "s.c.u.m.b.a.g water", "mooooron green", "1d10t"]
    docs += [(2000 + i, t) for i, t in enumerate(own)] + [(3000, None), (3001, ""), (3002, "green water 123"), (None, "moron")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id bigint, toxic int")
    rows = T.toxicity_of(df, lab).collect()
    got = {r.doc_id: r for r in rows}
    held = [i for i in range(1500) if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(1500))
    assert sum(got[i].predicted == (i % 5 == 0) for i in held) / len(held) > 0.98
    assert [got[2000 + i].predicted for i in range(len(own))] == [1] * len(own)
    assert [got[i].predicted for i in (3000, 3001, 3002)] == [0] * 3 and got[None].predicted == 1
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(docs)


def test_lighter_disguises(spark):
    docs, labels = corpus(random.Random(4), 1500)
    own = ["mmoorroonn", "the morron and", "m-o.r-o.n green", "mo ro n", "the sc um ba g water", "mor*on", "mor\u200bon house", "an id-iot", "scumm**bag"]
    clean = ["the green letter and a silent market", "it is in an or to be", "green-house, water's number", "green  market... and (the) letter"]
    docs += [(2000 + i, t) for i, t in enumerate(own)] + [(3000 + i, t) for i, t in enumerate(clean)]
    got = {r.doc_id: r for r in T.toxicity_of(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    assert [t for i, t in enumerate(own) if not got[2000 + i].predicted] == []
    assert [t for i, t in enumerate(clean) if got[3000 + i].predicted] == []


def test_no_labels_and_no_rows(spark, docs, none):
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    rows = T.toxicity_of(docs, empty).collect()
    assert len(rows) == docs.count() and {r.predicted for r in rows} == {0}
    assert T.toxicity_of(none, empty).collect() == []


def test_decoder_has_the_models_probabilities():
    import numpy as np

    from ratevane.llm import charlm
    from ratevane.llm.deobfuscate import Decoder

    x = np.array([ord(c) for c in "abracadabra abra cad bar "], np.uint32)
    model = charlm.Mixture([charlm.train(x, np.zeros(len(x), np.int64), 50)], 50)
    decoder = Decoder(model)
    for text in ("   a", "abra", "brac", "zzza", "a bz", "cad ", "qabr"):
        points = np.array([ord(c) for c in text], np.uint32)
        assert abs(decoder.logp(text[:-1], text[-1]) - float(model.score(points, np.zeros(4, np.int64))[-1, 0])) < 1e-6


def test_decoder_against_all_readings():
    import itertools

    import numpy as np

    from ratevane.llm import charlm, deobfuscate
    from ratevane.llm.deobfuscate import AGAIN, Decoder

    x = np.array([ord(c) for c in "moron idiot silly lilt tool moot solo sill "], np.uint32)
    decoder = Decoder(charlm.Mixture([charlm.train(x, np.zeros(len(x), np.int64), 50)], 50))
    memory = decoder.model.order - 1

    def best(text):
        top = None
        for choice in itertools.product(*(decoder.arcs(text, i) for i in range(len(text)))):
            for again in itertools.product((False, True), repeat=len(text)):
                read, value = " " * memory, 0.0
                for (c, cost), twice in zip(choice, again, strict=True):
                    value -= cost
                    if twice and (c in ("", " ") or read[-1] != c):
                        value = -np.inf
                    elif twice:
                        value -= AGAIN
                    elif c != "" and not (c == " " and read[-1] == " "):
                        value += decoder.logp(read[-memory:], c)
                        read += c
                value += decoder.logp(read[-memory:], " ") if read[-1] != " " else 0.0
                if top is None or value > top[0]:
                    top = (value, read)
        return top

    rng = random.Random(11)
    texts = ["m0r0n", "!d10t", "s1!|y", "mo-r.n", "too1", "1l|t"] + ["".join(rng.choice("mo0l1!-s t") for _ in range(5)) for _ in range(60)]
    for text in texts:
        value, read = best(text)
        plain = set(text.split())
        assert [w for w in read.split() if w not in plain] == [w for w in read.split() if w in decoder._viterbi(text) and w not in plain], text
        assert set(read.split()) <= set(decoder._viterbi(text)), text
    assert deobfuscate.WITHIN > 0


def test_the_model_depends_on_no_partitioning(spark):
    docs, labels = corpus(random.Random(5), 800)
    df, lab = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    one, other = (T.learn(df.repartition(n), lab.repartition(n)) for n in (1, 7))
    assert one.keys.tolist() == other.keys.tolist() and one.share.tolist() == other.share.tolist() and one.rest == other.rest


def test_keep_civil(spark, docs, none):
    lab = spark.createDataFrame([(i, int(i % 2)) for i in range(100, 160)], "doc_id bigint, toxic int")
    kept = T.keep_civil(docs, lab)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in T.toxicity_of(docs, lab).where("predicted = 0").collect())
    assert T.keep_civil(none, lab).collect() == [] and T.keep_civil(none, lab).columns == none.columns


def test_a_very_long_text(spark):
    docs, labels = corpus(random.Random(6), 600)
    long = "green water house " * 30_000
    docs += [(5000, long), (5001, long + "you m0r0n"), (5002, "t h i s " * 20_000)]
    got = {r.doc_id: r.predicted for r in T.toxicity_of(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")).where("doc_id >= 5000").collect()}
    assert got == {5000: 0, 5001: 1, 5002: 0}


def test_every_labelled_row_teaches(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(7))
    vocabulary, rare = [word() for _ in range(4000)], [word() + "zyx" for _ in range(12)]
    text = lambda *own: " ".join([*(rng.choice(vocabulary) for _ in range(6)), *own])
    rows = [(text("moron"), 1) for _ in range(13_000)] + [(text(w), 1) for w in rare for _ in range(3)] + [(text(), 0) for _ in range(13_000)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    learned = T.learn(docs, spark.createDataFrame([(i, x) for i, (_, x) in enumerate(rows)], "doc_id bigint, toxic int"))
    asked = spark.createDataFrame([(i, text(w)) for i, w in enumerate(rare)] + [(100, text())], "doc_id bigint, text string")
    assert {r.doc_id: r.predicted for r in T.score(asked, learned).collect()} == {**dict.fromkeys(range(len(rare)), 1), 100: 0}


def test_near_copies_weigh_one_text_together(spark):
    base = "silent market number letter water house green window garden river mountain bottle"
    docs = [(i, f"{base}{'.' * i}") for i in range(7)] + [(7, "an own text"), (8, "an own text of a toxic kind"), (9, None)]
    marked = spark.createDataFrame([(i, i == 8) for i in range(10)], "doc_id bigint, toxic boolean")
    rows = T._weighed(spark.createDataFrame(docs, "doc_id bigint, text string"), marked).collect()
    assert sorted((r.toxic, r.weight) for r in rows) == [(False, T.WHOLE // 7)] * 7 + [(False, T.WHOLE), (True, T.WHOLE)]


def bytes_of(texts):
    import numpy as np

    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *(len(r) for r in raw)])


def test_no_word_crosses_a_texts_end():
    texts = ["you moron", "green water", "", "house", "s"]
    f, t = T.features_of(*T.letters(*bytes_of(texts)))
    for i, own in enumerate(texts):
        assert sorted(f[t == i].tolist()) == sorted(T.features_of(*T.letters(*bytes_of([own])))[0].tolist()), own


def test_outlines_miss_no_reading():
    import numpy as np

    from ratevane.llm import charlm
    from ratevane.llm.deobfuscate import LEET, Outlines

    rng = random.Random(12)
    words = ["moron", "idiot", "silly", "lilt", "ass", "zoo", "scumbags", "naïveté", "abcdefghiklmn"]
    x = np.array([ord(c) for c in " ".join(words) + " the lot is in solo "], np.uint32)
    reader = T.Reader(charlm.Mixture([charlm.train(x, np.zeros(len(x), np.int64), 50)], 50))
    signs = {c: [k for k, v in LEET.items() if c in v] for c in "abcdefghiklmnoprstuvwxyz"}

    def disguised(w):
        out = ""
        for c in w:
            out += rng.choice([c, c, c.upper(), rng.choice(signs.get(c) or [c])]) * rng.choice([1, 1, 1, 2, 3]) + rng.choice(["", "", "", ".", "-", "*", " "])
        return rng.choice(["", "so ", "1", "the"]) + out + rng.choice(["", "s", "!", " is", "0"])

    texts = [disguised(rng.choice([*words, "water", "lotto", "green"])) for _ in range(1500)]
    data, off = bytes_of(texts)
    learned = ["moron", "idio", "sill", "ass", "scumb", "naïve", "abcdefghiklmn"]
    keys = np.sort(np.unique(T.features_of(T.stream(learned), np.repeat(np.arange(len(learned)), [len(w) + 1 for w in learned]))[0]))
    scorer = T.Scorer(keys, np.full(len(keys), 0.9), 0.01, reader, Outlines([w[:k] for w in learned for k in (4, 5, 99)]))
    value, restored = scorer.score(data, off)
    scorer.outlines = None  # every suspect is read
    all_value, all_restored = scorer.score(data, off)
    assert value.tolist() == all_value.tolist() and restored.tolist() == all_restored.tolist() and restored.sum() > 300
    outlines, points = Outlines(learned), np.frombuffer("green water".encode("utf-32-le"), "<u4")
    assert not outlines.may_hold(points, np.array([0, 6]), np.array([5, 11])).any()
