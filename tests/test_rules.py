"""The rule chain: own cases for each rule, written from what the rules say; its trail, its filter and lexicons."""

import random

import pytest
from pyspark.sql import functions as F

from libretto.functions import rules
from libretto.functions.numbers_it import cardinal, ordinal, words
from libretto.sources.lexicons import BUILT_IN, Entry, checked, compiled, load

#: (rule, text, what it becomes by that rule alone)
SINGLE = [
    ("unicode-cleanup", "perche\u0301 co\u00adsì\u00a0via…", "perché così via..."),
    ("dehyphenation", "lavo- \n\trare e ben-\nessere, poi -\nno", "lavorare e benessere, poi -\nno"),
    ("latex-cleanup", r"\begin {equation}\text {sale}\qquad 7{,}5\,\label {k}\quadro", r" sale  7,5 \quadro"),
    ("latex-operator", r"6\times2 \to z \toro 8\%", r"6 per 2  porta a  z \toro 8%"),
    ("latex-script", "C_10, x^2, b_{k}, 4^{3}, 5^q, ab_1", "ci con pedice 10, ics elevato alla 2, bi con pedice cappa, 4 elevato a 3, 5 elevato alla cu, ab_1"),
    ("equation-fraction", r"\frac{\frac{p}{q}} {w}", "p diviso q diviso w"),
    ("equation-operators", "u=v+w*2-k s-t", "u uguale a v più w per 2-k s meno t"),
    ("equation-identifiers", "u di kg e h", "u di kg e acca"),
    ("date", "1/7/1999, 32/1/2000, 8/13/2001, 09/10/2015", "primo luglio millenovecentonovantanove, 32/1/2000, 8/13/2001, nove ottobre duemilaquindici"),
    ("section-reference", "Sez. 4.12 e § b, CAPITOLO 9; sezione abc", "sezione quattro punto dodici e paragrafo bi, capitolo nove; sezione abc"),
    ("currency-range", "7-8 € o 0,5 – 1 $", "sette a otto euro o zero virgola cinque a uno dollaro"),
    ("percentage-range", "15--18 % e -2-4%", "quindici a diciotto per cento e meno due a quattro per cento"),
    ("range", "pagine 31 — 37, non a31-37", "pagine trentuno a trentasette, non a31-37"),
    ("percentage", "l'8 % e il 0,07%", "l'otto per cento e il zero virgola zero sette per cento"),
    ("currency", "£1, 2,01 €, $ 3.000,5, -4 $", "uno sterlina, due euro e uno centesimo, tremila dollari e cinquanta centesimi, meno quattro dollari"),
    ("ratio", "70 / 30 e 5/3/-2, ma 1/2/3/4", "settanta a trenta e cinque a tre a meno due, ma 1/2/3/4"),
    ("ordinal", "il 7° e la 2ª, ma 9 ° e 4ºx", "il settimo e la seconda, ma 9 ° e 4ºx"),
    ("abbreviation", "Prof. Neri, DOTT. Blu, art. 12, n.3, n. tre, ecc.", "professor Neri, dottor Blu, articolo  12, numero 3, n. tre, eccetera"),
    ("symbol", "sale&pepe + 2 £", "sale e pepe  più  2  sterline "),
    ("decimal", "-6.25 e 8,003 v1.2", "meno sei virgola venticinque e otto virgola zero zero tre v1.2"),
    ("integer", "17 gatti, -3 gradi, 4,5 e b52", "diciassette gatti, meno tre gradi, 4,5 e b52"),
    ("anni-elision", "Tanti anni fa, quanti anni hai? Nei recenti anni.", "Tanti anni fa, quanti anni hai? Nei recenti anni."),
    ("anni-elision", "duecentotrenta anni, Venti anni, ventuno anni, mille anni", "duecentotrent’anni, Vent’anni, ventuno anni, mille anni"),
    ("acronym", "la UE e il WWF di Roma, X", "la u e e il doppia vu doppia vu effe di Roma, X"),
    ("whitespace", " a  b \n\n\n\n c\t! \r\n", "a b c!"),
]


@pytest.mark.parametrize(("rule", "text", "spoken"), SINGLE)
def test_single_rules(rule, text, spoken):
    got, trail, _ = rules.applied(text, equation=True, only=(rule,))
    assert got == spoken
    assert trail == ([] if got == text else [(rule, text, spoken)])


def test_the_chain_leaves_nothing_to_say_again():
    text = "Il prof. Verdi paga $ 41,10 (il 9% in più) dal 2/6/2018 per 40 anni: l'INPS e il KTM, n. 5-6, art. 3 & altro."
    got, trail, warnings = rules.applied(text)
    assert got == "Il professor Verdi paga quarantuno dollari e dieci centesimi (il nove per cento in più) dal due giugno duemiladiciotto per quarant’anni: l'inps e il cappa ti emme, n. cinque a sei, articolo tre e altro."
    assert [t[0] for t in trail] == ["date", "range", "percentage", "currency", "abbreviation", "symbol", "integer", "anni-elision", "lexicon.finance-it.acronimo-inps", "acronym", "whitespace"]
    assert all(a[2] == b[1] for a, b in zip(trail, trail[1:], strict=False)) and trail[0][1] == text and trail[-1][2] == got
    assert warnings == [] and rules.applied(got)[1] == []


def test_an_equation():
    got, trail, warnings = rules.applied(r"\begin{equation}w_{3}=\frac{u}{8} \cdot 2^k\end{equation}", equation=True)
    assert got == "doppia vu con pedice tre uguale a u diviso otto per due elevato alla cappa" and warnings == []
    assert "equation-fraction" not in [t[0] for t in rules.applied(r"\frac{u}{8}")[1]]


def test_warnings():
    assert rules.applied(r"\sum #tag @ lei")[2] == ["unresolved-math: unsupported equation notation remains in spoken text", "unresolved-symbols: #@"]
    assert rules.applied("tutto bene")[2] == []


def test_numbers():
    assert [cardinal(n) for n in (31, 43, 78, 188, 2001, 5_000_003)] == ["trentuno", "quarantatré", "settantotto", "centottantotto", "duemilauno", "cinque milioni tre"]
    assert [ordinal(n) for n in (9, 14, 33, 56, 3000)] == ["nono", "quattordicesimo", "trentatreesimo", "cinquantaseiesimo", "tremillesimo"]
    assert words("-8.070,007") == "meno ottomilasettanta virgola zero zero sette"


def test_lexicons_take_precedence_by_priority_then_overlay_then_place(tmp_path):
    own = (Entry("a", "casa", "dimora", priority=1, lexicon_index=1), Entry("b", "casa", "tana", priority=1, lexicon_id="z", lexicon_index=2))
    assert rules.applied("La Casa.", own)[0] == "La tana."
    assert [n for n, _, _ in compiled((*BUILT_IN, *own))][-2:] == ["lexicon.z.b", "lexicon.local.a"]
    assert rules.applied("casale", own)[0] == "casale"
    for bad in ((own[0], own[0]), (Entry("x", "a*", "b", mode="regex", word_boundaries=False),)):
        with pytest.raises(ValueError):
            checked(bad)
    (tmp_path / "l.yaml").write_text("lexicon_id: mio\nentries:\n- {entry_id: u, pattern: 'h2o', spoken: acqua, notes: x}\n")
    entries = load(str(tmp_path / "l.yaml"))
    assert rules.applied("bevo H2O", entries)[0] == "bevo acqua" and entries[0].lexicon_id == "mio"
    with pytest.raises(ValueError, match="changed"):
        load(str(tmp_path / "l.yaml"), sha256="0")


def test_normalized_keeps_nulls_and_columns(spark):
    df = spark.createDataFrame([(1, "Cala del 6%.", "paragraph"), (2, None, "paragraph"), (3, "", "equation"), (4, "u", "equation"), (5, "u", None)], "id int, display_text string, kind string")
    got = {r.id: r for r in rules.normalized(df, kind="kind").collect()}
    assert got[1].spoken_text == "Cala del sei per cento." and got[1].transformations[0].rule_id == "percentage"
    assert got[2].spoken_text is None and got[2].warnings is None and got[3].spoken_text == "" and got[5].spoken_text == "u"
    assert rules.normalized(df.where("id = 4"), kind="kind").first().spoken_text == "u"


def test_texts_outside_the_filter_are_left_as_they_are(spark):
    rng = random.Random(4)
    pieces = ["sole", "Cent", "anni", "venti anni", "tanti anni", "PDF", "A", "è", "e\u0301", "7", "ecc", "ecc.", "sez. a", "appendice", "«", "»", "’", "…", "–", "-", "·", " ", "  ", "\n", "\u00a0", ".", ",", "BCE", "benchmark", "Å", "\u212b", "½", "§ c", "ª", "ǆ", "€", "par.\u2003b"]
    texts = [rng.choice([" ", ""]).join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", rules.touched(F.col("t")).alias("hit"))
    rows = df.collect()
    assert 300 < sum(not r.hit for r in rows)
    for r in rows:
        assert r.hit or rules.applied(r.t) == (r.t, [], []), r.t


def test_a_rule_never_needs_what_its_own_search_does_without(monkeypatch):
    rng = random.Random(6)
    pieces = ["3", "12", "4,5", "1.200", "7,50", "/", "-", "--", "–", " ", " ", "%", "€", "$", "º", "ª", "cap.", "Sez.", "§", "a", "C", "_", "^", "{2}", "\\times", "\\frac{a}{b}", "{,}", "·", "-\n", "art.", "N.", "ecc.", "cento anni", "VENTI ANNI", "ABC", "\\quad", "+"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    quick = [rules.applied(t, equation=True) for t in texts]
    monkeypatch.setattr(rules, "_NEEDS", {})
    assert quick == [rules.applied(t, equation=True) for t in texts]
