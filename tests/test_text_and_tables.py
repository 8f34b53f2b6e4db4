import random

from pyspark.sql import functions as F

from ratevane.functions import money, tables, text
from ratevane.sources import extract


def spelled(rng, shape):
    """A number of that shape, and whether it can be read."""
    digit = lambda n, first="0123456789": rng.choice(first) + "".join(rng.choice("0123456789") for _ in range(n - 1))
    return {
        "whole": lambda: (digit(rng.randint(1, 12), "123456789"), True),
        "point": lambda: (digit(rng.randint(1, 4)) + "." + digit(rng.randint(1, 32)), True),
        "groups": lambda: (digit(rng.randint(1, 3), "123456789") + "," + digit(3) + "." + digit(2), True),
        "long": lambda: (digit(rng.randint(13, 40), "123456789"), False),
        "fine": lambda: (digit(1) + "." + digit(rng.randint(33, 50)), False),
        "comma": lambda: (digit(1) + "," + digit(rng.choice((1, 2, 4))), False),
        "range": lambda: (digit(1) + "-" + digit(1), False),
    }[shape]()


def test_amounts_from_the_grammar():
    rng = random.Random(1)
    for _ in range(3000):
        shape = rng.choice(("whole", "point", "groups", "long", "fine", "comma", "range"))
        number, good = spelled(rng, shape)
        want = ([number], False) if good else ([], True)
        assert money.amounts(f"about ${number} each", "$") == want, number
        if shape != "range":
            assert money.amounts(f"about {number} EUR each", "", " EUR") == want, number
            assert money.amounts(f"about {number} each") == want, number


def test_ranges_fences_and_entities():
    rng = random.Random(2)
    for _ in range(400):
        a, b = (f"{rng.randint(0, 9)}.{rng.randint(10, 99)}" for _ in range(2))
        between = rng.choice(["-", " – ", " — ", " to ", "~", " ⁓ ", " -- ", "-~", " － "])
        assert money.amounts(f"¤{a}{between}¤{b}", "¤")[1], (a, between)
        assert money.amounts(f"{a}{between}{b} EUR", "", " EUR")[1], (a, between)
        assert money.amounts(f"¤{a} – {b}x the base", "¤") == money.amounts(f"¤{a} – {b} % of it", "¤") == ([a], False)
        assert money.amounts(f"~~¤{a}~~ ¤{b}", "¤") == ([a, b], False)
        assert money.amounts(f"¤{a}&ndash;{b}", "¤") == ([a], True)
        assert money.amounts(f"this &amp; that: ¤{a}", "¤") == ([a], False)
        assert money.amounts(f"¤{a}, then ¤{b}", "¤") == ([a, b], False)
    assert money.amounts("¤7, 25", "¤") == ([], True) and money.amounts("¤7.5, 25 users", "¤") == (["7.5"], False)
    assert money.amounts("$4 or ＄5", "$") == (["4"], True) and money.amounts("$4 (5$ before)", "$")[1]
    assert money.amounts("&#" + "0" * 5000 + "36;2", "$")[0] == [] and money.amounts(None, "$") == ([], False) and money.amounts("none", "$") == ([], False)


def test_tables():
    assert tables.markdown_tables("x\n| A | B |\n|---|:-:|\n| 1 | 2 |\n\n| not | one |\n") == [[["A", "B"], ["1", "2"]]]
    page = "<table><tr><th colspan=2>A</th></tr><tr><td>1<table><tr><td>in</td></tr></table></td><td>2 &amp; 3</td></tr><tr></tr></table><script><table></script>"
    assert tables.html_tables(page) == [[["A", "A"], ["1 in", "2 & 3"]]]
    assert tables.html_tables(None) == [] and tables.html_tables("<table><tr><td>open") == [[["open"]]]


def test_extractor(spark):
    page = "<table><tr><th>Model</th><th>Input &amp; more</th><th>Output</th></tr><tr><td>a-1</td><td>$0.50</td><td>$1.50</td></tr><tr><td>b</td><td>$0,50</td><td>$1</td></tr><tr><td>c</td><td>-</td><td>-</td></tr><tr><td>a-1</td><td>$9</td><td>$9</td></tr></table>"
    pages = spark.createDataFrame([("x", "u", page), ("y", "v", page)], "source string, url string, body string")
    x = extract.Extractor("x", "model", {"input and more": "input", "output": "output"}, spellings=(("-", "_"),))
    got = {r.model_id: r for r in extract.prices(pages, x).collect()}
    assert (got["a-1"].rates.input, got["a-1"].rates.output, got["a-1"].malformed) == (0.5, 1.5, False)
    assert got["b"].rates is None and got["b"].malformed and got["c"].rates is None and not got["c"].malformed
    assert sorted(r.model_id for r in extract.detected(pages, x).collect()) == ["a-1", "c"]
    ids = spark.createDataFrame([("a-1",), ("z",)], "model_id string")
    stored = spark.createDataFrame([("a_1",)], "model_id string")
    assert {r.model_id: r.stored_id for r in extract.stored_spelling(ids, stored, x).collect()} == {"a-1": "a_1", "z": None}


def test_scalars(spark):
    df = spark.createDataFrame([("https://h.example/a/b/?q#f", 2.5, "One. Two! Three", "2026-02-30", "a%b\nc"), ("https://h.example", 0.05, "x", "2026-02-28", "")], "u string, p double, t string, d string, c string")
    c = F.col
    got = df.select(text.slug(c("u")), text.usd(c("p")), text.unwrapped(text.wrapped(c("t"))) == c("t"), text.real_day(c("d")), text.command(c("c"))).collect()
    assert [tuple(r) for r in got] == [("b", "$2.50", True, False, "a%25b%0Ac"), ("index", "$0.0500", True, True, "")]
    assert spark.range(1).select(text.usd(F.lit(0.001234)), text.tokens(F.lit("128K tokens")), text.tokens(F.lit("1.9M"))).first()[:] == ("$0.00123", 131072, 1048576)
