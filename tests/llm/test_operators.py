import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from furniture_lines import BODY, FURNITURE
from pii_lines import LINES, NOTHING

from sieveline.llm import boilerplate, leakage, level, markup, packing, pii, quality, queries, repeated, residue, visual
from sieveline.llm.common import table

# markup


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("<p>a</p>", ["html"]), ("a &amp; b", ["html"]), ("&lt;li&gt;a", ["html"]), ("x <!-- c --> y", ["html"]), ("R&D, Salt & pepper, thickness < 12 mm and > 3", []), ("I <3 it, the #1 request", []),
        ("## Head", ["markdown"]), ("see [a](https://x/y) now", ["markdown"]), ("a **bold** word", ["markdown"]), ("use `code` here", ["markdown"]), ("Notes\n-----\nx", ["markdown"]), ("| a | 5 |", ["markdown"]), ("> quoted", ["markdown"]), ("__Note__ mix", ["markdown"]),
        ("== Steps ==", ["wiki"]), ("the [[Sauce|sauce]] is", ["wiki"]), ("an '''old''' pot", ["wiki"]), ("{{convert|3|F|C}}", ["wiki"]), ("{| class=\"x\"\n|-\n| a || b\n|}", ["wiki"]),
        ("\\section{A}", ["latex"]), ("\\item one", ["latex"]), ("$\\frac{1}{2}$ cup", ["latex"]), ("costs $4 to $6", []), ("and\\or a spoon", []),
        ("[Image: https://x/y.png]", []), ("* star\n- dash\n1. one", []), ("2 * 3 or 3 * 4", []), ("{{product.name}} ${x} [[INSERT x HERE]] __x__ #a_b#", []), ("best_4_minute_dinner", []), ("Home | About | Shop", []), ("", []),
    ],
)
def test_markup_kinds(text, kinds):
    assert markup.analyse(text)[0] == kinds


def test_markup_clean_keeps_structure():
    page = '<h2>Steps</h2><ol><li>Beat&nbsp;it</li><li>Bake</li></ol><pre><code>x = 1\n</code></pre><script>no()</script><img src="u.jpg">'
    assert markup.analyse(page)[1].split("\n") == ["## Steps", "1. Beat\xa0it", "2. Bake", "```", "x = 1", "```", "[Image: u.jpg]"]
    assert markup.analyse("<h3>A</h3>\n<ul>\n<li>one</li>\n<li>two</li>\n</ul>\n<img src='u.png'>\n<div>\n</div>\nEnd")[1].split("\n") == ["### A", "- one", "- two", "[Image: u.png]", "End"]
    assert markup.analyse("&lt;p&gt;Twice &amp;amp; escaped&lt;/p&gt;")[1] == "Twice & escaped"
    assert markup.analyse("\\subsection*{Notes}\n\\item $\\frac{1}{2}$ cup\n$w \\leq 3$")[1] == "### Notes\n- 1/2 cup\n$w \\leq 3$"
    assert markup.analyse("== H ==\n[[A|b]] '''c'''")[1] == "## H\nb c"
    assert markup.analyse("# H\n**b** [t](http://u) ![i](http://v)")[1] == "# H\nb t [Image: http://v]"


def test_regions_of_links_are_no_content():
    links = ['<a href="/">Home</a> | <a href="/r">Recipes</a> | <a href="/a">About us</a>', '<div><a href="/s">Soups</a> <a href="/c">Cakes</a></div>', '<span><a href="/l">Log in</a></span>']
    body = ["<p>Boil the rice in plenty of salted water.</p>", "<div>Oil</div>", "<p>See <a href='/x'>the notes</a> for other grains, and read them first.</p>", "<ul>", "<li><a href='/f'>flour</a></li>", "<li>salt</li>", "</ul>"]
    page = "\n".join([*links, *body])
    tags, _ = markup.parse_html(page)
    assert markup.content_regions(page, tags) == [False] * 3 + [True] * 7
    assert markup.analyse(page)[1] == "Boil the rice in plenty of salted water.\nOil\nSee the notes for other grains, and read them first.\n- flour\n- salt"
    # one cluster: nothing to tell apart
    assert all(markup.content_regions("\n".join(links), markup.parse_html("\n".join(links))[0]))


def test_escapes_of_any_depth():
    text = "<b>Salt</b>"
    for _ in range(6):
        text = text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    assert markup.analyse(text) == (["html"], "Salt")
    assert markup.analyse("a < b & c") == ([], "a < b & c") and markup.analyse("a < b &amp; <i>c</i>") == (["html"], "a < b & c")


# personal information


def test_crf_on_held_out_sentences(model):
    table_, bad = pii.labelled_table(model.lexicon, seed=77, size=600), 0
    for text, want in table_:
        got = [x for _, line, found in pii.find(model, [text])[0] for x in found] if text else []
        bad += set(got) != set(want)
    assert bad / len(table_) < 0.05


def test_crf_on_lines_of_other_wording(model):
    lines = [x for x, _ in LINES]
    want, hit, extra = Counter(k for _, k in LINES), Counter(), 0
    for (_, kind), found in zip(LINES, pii.find(model, lines)):
        kinds = [k for _, _, spans in found for _, _, k in spans]
        hit[kind] += kind in kinds
        extra += sum(k != kind for k in kinds)
    assert all(hit[k] >= 0.9 * n for k, n in want.items()), hit
    assert extra <= 2 and sum(map(bool, pii.find(model, NOTHING))) <= 1
    # the table was made without these lines
    clauses = [x.lower() for v in pii.CLAUSES.values() for c in v.split("\n") for x in re.split(r"\{\w+\}|<\w+>", c) if len(x) >= 15]
    assert not [x for x in clauses for line in lines if x in line.lower() and not re.search("national insurance|social security|passport|licen", x)]


def test_table_holds_no_text_of_the_tables(spark):
    texts = "\n".join(r[0] for r in table(spark, "/root/testdata/sf0.01", "example_clean").selectExpr("meta.data_info.content").dropna().collect())
    words = set(re.findall(r"\w+", texts))
    assert not words.intersection([*pii.GIVEN, *pii.FAMILY, *pii.TOWNS]) and not [d for d in pii.DOMAINS if d in texts]
    usual = {"social security number", "national insurance number", ". all rights reserved.", "driver licence no.", "under driver licence no.", "under social security number", "driving licence number", "nutrition information"}
    pieces = [x.strip() for v in pii.CLAUSES.values() for c in v.split("\n") for x in re.split(r"\{\w+\}|<\w+>", c)]
    assert not [x for x in pieces if len(x) >= 15 and x.lower() not in usual and x in texts]


def test_gate_loses_no_item(model):
    # what the gate leaves out holds no span that passes the exact check, whatever the field says of it
    texts = [t for t, _ in pii.labelled_table(model.lexicon, seed=5, size=1500)] + [x for x, _ in LINES] + NOTHING
    for text in texts:
        if not pii.possible(text):
            _, places = pii.tokenize(text)
            assert not [k for a, _ in places for _, b in places if b > a for k in pii.KINDS if pii.valid(k, text[a:b])], text


def test_training_learns_from_a_small_table():
    small = pii.train(size=1200, rounds=60)
    got = pii.find(small, ["Write to me at someone@letters.net today.", "Call (415) 555-2671 for bread."])
    assert [[k for *_, k in spans] for found in got for _, _, spans in found] == [["email"], ["phone"]]


def test_viterbi_equals_brute_force(model):
    import itertools

    import numpy as np

    line = model.ids(pii.tokenize("Call Ivo Quill")[0])
    pad = [model.boundary] * pii.REACH
    ids = np.array(pad + line + pad)
    emit = sum(model.rows[ids[pii.REACH + o : pii.REACH + o + len(line)], o + pii.REACH] for o in range(-pii.REACH, pii.REACH + 1))
    score = lambda tags: model.start[tags[0]] + sum(emit[t, k] for t, k in enumerate(tags)) + sum(model.transitions[a, b] for a, b in zip(tags, tags[1:]))
    best = max(itertools.product(range(pii.K), repeat=len(line)), key=score)
    assert list(model.decode([line])[0]) == list(best)


def test_masking_leaves_the_rest(spark, model):
    text = "Plain line\nFоr the\u200b class, tеxt 313-555-0159 or mail ivo.quill@mailb\u200barn.test before ﬁne Fride\u0301ay.\nÜber ﬁne"
    df = spark.createDataFrame([(1, text)], "k int, t string")
    assert pii.masked(df, "k", "t", model).first().clean == "Plain line\nFоr the\u200b class, tеxt [PHONE] or mail [EMAIL] before ﬁne Fride\u0301ay.\nÜber ﬁne"


# boilerplate and quality


def test_furniture():
    page = "\n".join(["Home", "Recipes | About | Shop", "[Image: https://www.oatandbroth.test/a.jpg]", "We use cookies to measure traffic.", "Stir the oats.", "Ingredients:", "fresh basil", "Granny Smith apples", "Instructions:", "Share the work and print nothing.", "© 2021 Oat & Broth. All rights reserved.", "", "Browse by topic", "Tofu (49)", "Old-Style Oat Hash", "4.1 from 12 votes", "Please enable JavaScript to rate this page.", "Oat & broth says hello"])
    assert boilerplate.furniture(page, "https://www.oatandbroth.test/x") == [1, 2, 4, 11, 13, 14, 15, 16, 17, 18]
    assert boilerplate.body("a\nHome\nb") == "a\nb"


def furniture_of_pages(seed):
    """Unseen lines in ten pages of furniture and body; what was missed, and what of the body was taken."""
    r = random.Random(seed)
    site, own = FURNITURE[:], BODY[:]
    r.shuffle(site)
    r.shuffle(own)
    missed, taken = [], []
    for k in range(0, 50, 5):
        f, b = site[k : k + 5], own[k : k + 5]
        page = [*f[:2], "A Plain Page", *b[:3], f[2], *b[3:], *f[3:]]
        got = set(boilerplate.furniture("\n".join(page)))
        missed += [line for i, line in enumerate(page, 1) if line in f and i not in got]
        taken += [line for i, line in enumerate(page, 1) if line in b and i in got]
    return missed, taken


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_furniture_of_unseen_wording(seed):
    assert len(FURNITURE) == len(BODY) == 50
    assert sum(not boilerplate.role(x) for x in FURNITURE) >= 20  # no list holds these
    missed, taken = furniture_of_pages(seed)
    assert len(missed) <= 5 and len(taken) <= 3, (missed, taken)


def test_weights_come_from_labelled_lines(spark):
    pages = table(spark, "/root/testdata/sf0.01", "example_clean").selectExpr("meta.data_info.content AS c", "meta.data_info.url AS u").dropna().collect()
    rows = [x for r in pages[:400] for x in boilerplate.labelled(r.c, r.u)]
    weights = boilerplate.fit(rows, rounds=300)
    page = "\n".join(BODY[:8] + FURNITURE[:8])
    right = set(boilerplate.furniture(page, weights=weights)) ^ set(range(9, 17))
    assert len(weights) == len(boilerplate.WEIGHTS) == len(boilerplate.FEATURES) and len(right) <= 2, right


def test_ratios_decide_about_furniture():
    # a wording in running text is body, and without the ratios nearly nothing is told apart
    page = "\n".join(BODY[:6] + ["Accept all the help you can get, share the chopping and follow the steps until the sauce is done."] + FURNITURE[:3])
    assert boilerplate.furniture(page) == [8, 9, 10]
    ratios = {"path punctuation", "site words", "site words of path", "site words of block", "site words near", "no site word"}
    off = tuple(0.0 if name in ratios else w for name, w in zip(boilerplate.FEATURES, boilerplate.WEIGHTS))
    assert boilerplate.furniture(page, weights=off) != [8, 9, 10]
    row = " | ".join(["Home", "About us", "Contact", "Newsletter", "Recipes", "Privacy policy"] * 8)
    assert len(row) > 200 and boilerplate.furniture("Boil the rice in salted water until done.\n" + row) == [2]


def test_shapes_against_labels(spark, sf):
    rows = table(spark, "/root/testdata/sf0.1", "shape_labels").join(table(spark, "/root/testdata/sf0.1", "example_clean").selectExpr("rec_no", "meta.data_info.content AS c", "meta.data_info.url AS u"), "rec_no").where("c IS NOT NULL").collect()
    hits = Counter(quality.shape(quality.statistics(r.c, r.u)) == r["shape"] for r in rows)
    assert hits[True] / len(rows) > 0.98


def test_statistics():
    s = quality.statistics("The cat sat on the mat.\nThe cat sat on the mat.\n\nThe cat sat on the mat.")
    assert (s["words"], s["duplicate_line_share"], s["end_share"], s["duplicate_paragraph_share"]) == (18, pytest.approx(2 / 3), 1.0, 0.0)
    assert s["mean_word_length"] == pytest.approx(17 / 6) and s["top_2gram_share"] == pytest.approx(3 * 6 / 51)


def test_repetition_decides_about_junk():
    line = "The cat sat on the mat and then it looked at me for a while."
    assert quality.line_kind(line, residue.EVERYDAY) == "sentence"
    assert quality.shape(quality.statistics("\n".join([line] * 12))) == "junk"
    assert quality.shape(quality.statistics(" ".join(["the oats are in the pot and"] * 40))) == "junk"
    assert quality.shape(quality.statistics("\n".join([line, *BODY[:8]]))) == "prose"
    assert quality.line_kind("橄榄油 两勺", residue.EVERYDAY) == "entry" and quality.line_kind("把水倒在锅里，再煮一下。", residue.EVERYDAY) == "sentence"


# repeated lines


def test_repeated_lines_against_brute_force(spark):
    r = random.Random(3)
    notices = ["All rights reserved by this fine site 2021", "Share this page with all of your friends", "short line"]
    rows = []
    for i in range(400):
        site = r.choice(["hot.test"] * 6 + ["b.test", "c.test", "WWW.d.test:80"])
        lines = [f"Body {r.random()} with enough words in it"] + [n.replace("2021", str(r.randint(1999, 2030))) if r.random() < 0.5 else "  " + n.upper().replace(" ", " \t") for n in notices if r.random() < 0.15]
        rows.append((i, f"https://{site}/{i % 350}", "\n".join(lines) if r.random() < 0.95 else None))
    df = spark.createDataFrame(rows, "k int, u string, t string")
    form = lambda s: re.sub("[0-9]+", "0", re.sub("[ \t]+", " ", s).strip(" ").lower())
    site = lambda u: re.sub(r"^www\.", "", u.split("//")[1].split("/")[0].lower()).split(":")[0]
    urls, seen = defaultdict(set), defaultdict(set)
    for _, u, t in rows:
        urls[site(u)].add(u)
        for line in (t or "").split("\n") if t is not None else []:
            if len(form(line)) >= 25:
                seen[site(u), form(line)].add(u)
    excess = {k for k, v in seen.items() if len(v) >= 5 and len(v) >= 0.1 * len(urls[k[0]])}
    want = sorted((k, i) for k, u, t in rows if t is not None for i, line in enumerate(t.split("\n"), 1) if (site(u), form(line)) in excess)
    assert want and sorted((x.k, x.line_no) for x in repeated.excess_occurrences(df, "k", "t", "u").collect()) == want
    cleaned = {x.k: x.clean for x in repeated.remove_excess(df, "k", "t", "u", significant=False).collect()}
    assert cleaned == {k: None if t is None else "\n".join(line for line in t.split("\n") if (site(u), form(line)) not in excess) for k, u, t in rows}
    # the same lines stand on every site, so hardly any is in excess of the others; the control keeps what isn't
    sure = significant_lines(excess, seen, urls)
    assert sure < excess
    cleaned = {x.k: x.clean for x in repeated.remove_excess(df, "k", "t", "u").collect()}
    assert cleaned == {k: None if t is None else "\n".join(line for line in t.split("\n") if (site(u), form(line)) not in sure) for k, u, t in rows}


def significant_lines(excess, seen, urls, fdr=0.01):
    """Benjamini-Hochberg over the p-values themselves, without bins."""
    import math

    total, p, more = sum(map(len, urls.values())), {}, {}
    for s, f in excess:
        k, n = len(seen[s, f]), len(urls[s])
        k2, n2 = sum(len(v) for (a, b), v in seen.items() if b == f) - k, total - n
        e = (k + k2) / (n + n2)
        term = lambda x, y: x * math.log(x / y) if x else 0.0
        g = 2 * (term(k, n * e) + term(n - k, n * (1 - e)) + term(k2, n2 * e) + term(n2 - k2, n2 * (1 - e)))
        p[s, f], more[s, f] = math.erfc(math.sqrt(max(g, 0) / 2)), k / n > k2 / max(n2, 1)
    order = sorted(p, key=p.get)
    last = max((i for i, x in enumerate(order, 1) if p[x] <= fdr * i / len(order)), default=0)
    return {x for x in order[:last] if more[x]}


def test_a_line_of_one_site_is_significant(spark):
    rows = [(i, f"https://{'abcd'[i % 4]}.test/{i}", f"Body {chr(97 + i % 26)}{chr(97 + i // 26)} alone\n" + ("Subscribe to the letter of a.test every week" if i % 4 == 0 else "")) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, u string, t string")
    assert {x.k: x.clean for x in repeated.remove_excess(df, "k", "t", "u").collect()} == {k: "\n".join(x for x in t.split("\n") if "Subscribe" not in x) for k, _, t in rows}


def test_occurrences_count_no_other_sites(spark, monkeypatch):
    rows = [(i, f"https://{'abcd'[i % 4]}.test/{i}", "All rights reserved by whoever wrote this\ny") for i in range(80)]
    df = spark.createDataFrame(rows, "k int, u string, t string")
    # no site has the line more often than others: listed by the definition, kept by the control
    assert {x.significant for x in repeated.excess_lines(df, "t", "u").collect()} == {False}
    assert {x.k: x.clean for x in repeated.remove_excess(df, "k", "t", "u").collect()} == {k: t for k, _, t in rows}
    monkeypatch.setattr(repeated, "excess_lines", None)  # the rows don't depend on the ratio, so it is no stage of theirs
    assert sorted(map(tuple, repeated.excess_occurrences(df, "k", "t", "u").collect())) == [(i, 1) for i in range(80)]
    monkeypatch.setattr(repeated, "MAX_SENT_LINES", 0)
    assert sorted(map(tuple, repeated.excess_occurrences(df, "k", "t", "u").collect())) == [(i, 1) for i in range(80)]
    # one count of the lines, one join with the sites' urls
    plan = repeated._excessive(*repeated._counts(df, "t", "u", 25), 5, 0.1)._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("Generate posexplode"), plan.count("Join ")) == (1, 1)


def test_lines_joined_by_site_where_the_table_is_large(spark, monkeypatch):
    rows = [(i, f"https://{'abcd'[i % 4]}.test/{i}" if i % 7 else None, "Subscribe to the letter of this site every week\nx" if i % 4 == 0 else "y") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, u string, t string")
    want = sorted(map(tuple, repeated.remove_excess(df, "k", "t", "u").collect()))
    monkeypatch.setattr(repeated, "MAX_SENT_LINES", 0)
    assert sorted(map(tuple, repeated.remove_excess(df, "k", "t", "u").collect())) == want and (0, "Subscribe to the letter of this site every week\nx") in want and (4, "x") in want


# look-alikes


def test_trie_automaton():
    trie = visual.Trie(["flour", "fine", "café", "for"])
    assert trie.match("ﬂоur") == "flour" and trie.match("fi\u200bne") == "fine" and trie.match("cafe\u0301") == "café" and trie.match("ｆｏｒ") == "for"
    assert trie.match("cafe") is None and trie.match("floor") is None
    assert trie.match("floor", budget=1) == "flour" and trie.match("fne", budget=1) == "fine" and trie.match("flouur", budget=1) == "flour"


def test_fold_and_pairs(spark):
    texts = ["Boil the rice", "Bоil the rice", "Boil\xa0the ｒｉｃｅ", "Boil the rice", "Boil the ricé", "Boil the rice.", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    pairs = sorted(tuple(r) for r in visual.lookalike_pairs(df, "k", "t", ["rice"]).collect())
    assert pairs == [(0, 1), (0, 2), (1, 2), (1, 3), (2, 3)]
    words = visual.Canonicalizer(["rice", "boil"])
    assert all(words(t) == visual.fold_table(t) for t in texts if t)  # what the table lists needs no vocabulary
    classes = sorted(tuple(r) for r in visual.lookalike_classes(df, "k", "t", ["rice"]).collect())
    assert classes == [(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 0)]


def test_vocabulary_settles_letters_that_no_table_lists(spark):
    # a Cyrillic izhitsa, a Latin alpha and an Armenian letter within English words
    texts = ["Add vanilla and a carrot", "Add \u0475anilla and a carrot", "Add vanilla and a c\u0251rrot", "Add van\u056cla and a carrot", "Add vanilla and a parrot"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    vocabulary = visual.vocabulary_of(["vanilla", "carrot", "parrot", "rice"])
    assert sorted(r.k for r in visual.lookalike_classes(df, "k", "t", vocabulary).collect()) == [0, 1, 2]
    assert visual.lookalike_classes(df, "k", "t").count() == 0  # without the vocabulary nothing is settled
    words = visual.Canonicalizer(vocabulary)
    assert words("\u0475\u0475nilla") == "\u0475\u0475nilla".replace("\u0475\u0475", "va") and words("\u03c0arrot") == "\u03c0arrot"  # carrot or parrot
    assert words("ванилла") == visual.fold_table("ванилла") and words("猫 π = 3") == "猫 π = 3"


# residue


@pytest.mark.parametrize(
    ("text", "is_residue"),
    [
        ("{{ingredient_1}}", True), ("Serve with ${recipe_title} and stir.", True), ("[[INSERT step_text HERE]]", True), ("TODO: servings", True), ("Your text goes here.", True), ("404 - the page you are looking for could not be found.", True),
        ("Error 30: access denied. You do not have permission to view this post.", True), ("Please enable JavaScript to view this article.", True), ("Lorem ipsum velit porta.\nRutrim magnaris velit sodalis.", True), ("Sample caption, replace before publishing.", True),
        ("A dish for two.\nIngredients:\noats\nInstructions:\nInternal server error while loading template 28.", True), ("Access was denied to the top shelf, so we did without.", False), ("Choose [mild] or [hot] fennel.", False),
        ("Stir the oats.\nPlease enable JavaScript to rate this page.", False), ("If your dishwasher shows error 404 or E2, clean it.", False), ("The word TODO is all you need.", False), ("You do not need scripts for this.", False), ("See {{convert|3|F|C}} and [[Category:Soup]].", False),
    ],
)
def test_residue_wording(text, is_residue):
    assert residue.examine(text)[0] == is_residue


@pytest.mark.parametrize(
    "text",
    ["[[first_name]], your order is ready", "<your text here>", "Server responded with 522", "Dear {customer}, welcome", "Insert title here", "Click to edit this text", "Please add your description here", "<insert ingredients>", "We're sorry, this content is unavailable.",
     "The connection timed out.", "You must have JavaScript enabled to use this recipe.", "$recipe.title$", "[%= name %]", "#{title}", "The requested URL was not found on this server.", "Your browser does not support JavaScript"],
)
def test_residue_of_other_forms(text):
    assert residue.examine(text)[0]


@pytest.mark.parametrize("text", ["\\frac{cup}{two} of oats", "print(f'{tray}')", "a {x} b", "The server responded with a smile.", "See [[Category:Soup_dishes|soups]]", "It costs $5.50 or $6.20 here.", "The <b>best</b> rice", "Add your own spices here and there."])
def test_what_looks_like_residue_and_is_none(text):
    assert not residue.examine(text)[0]


def test_open_slots_are_induced_from_the_corpus(spark):
    rows = [(i, f"https://a.test/{i}", t) for i, t in enumerate(["Add [servings] now.", "Add {servings} now.", "Serve #servings# hot.", "Pick [mild] now.", "Pick [mild] now.", "Pick [mild] now."])]
    df = spark.createDataFrame(rows, "k int, u string, t string")
    assert sorted(r.k for r in residue.residue(df, "k", "t", "u").collect()) == [0, 1, 2]
    assert residue.without_residue(df, "k", "t", "u").count() == 3


def test_slots_are_induced_from_aligned_lines(spark):
    plain = ["Oat stew\nServes 4 people.", "Bean soup\nServes 6 people.", "Leek pie\nServes 12 people.", "Title:\nRye", "Title:\nOat stew with leeks", "Title:\nBeans", "Done in 4 steps, 20 minutes.", "Done in 5 steps, 30 minutes.", "Done in 4 steps, 9 minutes."]
    left = ["Serves [servings] people.", "Serves ___ people.", "Serves  people.", "Serves undefined people.", "Title:\n{title}", "Done in {steps} steps, {time} minutes."]
    other = ["Pick [mild] now.", "Pick [hot] now.", "\\section*{Notes}", "__Four__ eggs.", "__Note__ Chill the dough.", "It is late. Chill the dough.", "<p>Chill the dough.", "Be quick! Chill the dough."]
    rows = [(i, f"https://a.test/{i}", t) for i, t in enumerate(left + plain + other)] + [(99, "https://b.test/1", left[0])]  # b.test shows no other filler
    df = spark.createDataFrame(rows, "k int, u string, t string")
    assert sorted(r.k for r in residue.residue(df, "k", "t", "u").collect()) == list(range(len(left)))


def test_marks_of_evident_rows_count_for_a_name(spark):
    rows = [(0, "https://a.test/0", "{{servings}}"), (1, "https://a.test/1", "Add [servings] now."), (2, "https://a.test/2", "Try [servings]"), (3, "https://a.test/3", "Try [mild]"), (4, "https://a.test/4", "\\section*{mild}"), (5, "https://a.test/5", "Add [mild]")]
    assert sorted(r.k for r in residue.residue(spark.createDataFrame(rows, "k int, u string, t string"), "k", "t", "u").collect()) == [0, 1, 2]


def test_residue_in_one_long_line():
    error = "Error 404. The page you are looking for could not be found. It may have been moved or deleted. Please try again later. If the problem persists, contact the webmaster. Go back to the start page. Something went wrong on our side. The server took too long to answer. Use the search box above."
    assert len(error) > 260 and residue.examine(error)[0]
    assert residue.examine("Please enable JavaScript to view this recipe. " * 8)[0] and residue.examine("This is placeholder text. Sample text for the page. " * 6)[0]
    prose = "The jar we wanted could not be found. " + "Stir the oats over a low flame, then add the leeks and let them rest for a while. " * 4
    assert not residue.examine(prose)[0]


def random_match(r, pattern):
    """A text that a parsed pattern may match; assertions are left out."""
    out = ""
    for op, value in pattern:
        op = str(op)
        if op == "LITERAL":
            out += chr(value)
        elif op == "BRANCH":
            out += random_match(r, r.choice(value[1]))
        elif op == "SUBPATTERN":
            out += random_match(r, value[3])
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(random_match(r, value[2]) for _ in range(r.randint(value[0], min(value[1], value[0] + 2))))
        elif op == "IN":
            kind, x = r.choice(value)
            out += chr(x) if str(kind) == "LITERAL" else "7" if str(x) == "CATEGORY_DIGIT" else str(kind) == "RANGE" and chr(x[0]) or " "
        elif op in ("ANY", "NOT_LITERAL"):
            out += " "
    return out


def test_gate_lets_every_wording_through():
    from re import _parser

    r = random.Random(4)
    seen = Counter()
    for p in (residue.ERROR, residue.FOLLOW_UP, residue.FILLER, residue.BLANK, residue.SCRIPT):
        tree = _parser.parse(p.pattern, p.flags)
        for _ in range(3000):
            line = r.choice(["", "", "Oh, "]) + random_match(r, tree) + r.choice(["", "s", " here", " must be on"])
            if line.strip() and residue.state(line):
                seen[residue.state(line)] += 1
                assert residue.may_tell(line), line
    assert min(seen[k] for k in ("error", "follow", "filler", "blank", "script")) > 100


@pytest.mark.parametrize("text", ["Consectetur adipiscing elit, sed eiusmod tempor", "That link is dead", "500 internal", "403 unauthorised"])
def test_residue_whose_words_the_gate_left_out(text):
    assert residue.examine(text)[0]


def test_blank_lines_of_letters_count():
    assert all(residue.examine(f"Soup\n{x}")[2] for x in ("N/A", "xxx"))  # half of a page of weak wording


# packing


def test_best_fit_is_valid_and_tight():
    r = random.Random(1)
    sizes = [r.randint(0, 100) for _ in range(3000)]
    bins, fill = packing.best_fit(sizes, 100)
    sums = Counter()
    for b, s in zip(bins, sizes):
        sums[b] += s
    assert [sums[b] for b in range(len(fill))] == fill and max(fill) <= 100
    assert len(fill) <= 1.02 * sum(sizes) / 100 + 1


@pytest.mark.parametrize("per_group", [50, 400, 100000])
def test_packing_invariants(spark, per_group):
    r = random.Random(2)
    sizes = [(i, r.choice([0, 3, 40, 51, 64, 65, 200, r.randint(1, 64)])) for i in range(1500)] + [(7, 10), (7, None)]
    df = spark.createDataFrame(sizes, "k int, n int")
    caps = spark.createDataFrame([(1, 64), (2, 1000)], "capacity_id int, max_tokens int")
    packed = packing.pack(df, "k", "n", caps, items_per_group=per_group).collect()
    for c, most in ((1, 64), (2, 1000)):
        mine = [p for p in packed if p.capacity_id == c]
        fill = Counter()
        for p in mine:
            fill[p.container] += p.piece_tokens
        assert max(fill.values()) <= most
        assert sum(p.piece_tokens for p in mine) == sum(n or 0 for _, n in sizes)
        assert len(mine) == sum(max(1, -(-(n or 0) // most)) for _, n in sizes)
        pieces = [min(most, (n or 0) - k * most) for _, n in sizes for k in range(max(1, -(-(n or 0) // most)))]
        assert len(fill) <= 1.05 * len(packing.best_fit(pieces, most)[1]) + 2


def test_tree_goes_on_where_residual_bins_exceed_a_group(spark):
    # a few items to a group, so that small ones often meet no large one
    sizes = [90] * 100 + [5] * 40 + [15] * 12
    df = spark.createDataFrame(list(enumerate(sizes)), "k int, n int")
    caps = spark.createDataFrame([(1, 100)], "capacity_id int, max_tokens int")
    packed = packing.pack(df, "k", "n", caps, items_per_group=4, fan_in=8).collect()
    fill = Counter()
    for p in packed:
        fill[p.container] += p.piece_tokens
    assert sum(fill.values()) == sum(sizes) and max(fill.values()) <= 100
    assert max(int(p.container.split(".")[0]) for p in packed) > 1  # it once ended after one level


def test_sizes_are_the_tokenizers(spark, sf):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    rows = packing.token_sizes(table(spark, sf, "documents"), "doc_id", "text").join(table(spark, sf, "documents"), "doc_id").collect()
    assert all(r.n_tokens == (len(t.encode(r.text, add_special_tokens=False)) if r.text else 0) for r in rows)


# leakage


def edit(a, b):
    """Least edits from ``a`` to some stretch of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    r = random.Random(5)
    for _ in range(2000):
        a, b = [r.choice("abc") for _ in range(r.randint(1, 9))], [r.choice("abc") for _ in range(r.randint(0, 14))]
        assert leakage.myers(a, b, 99) == edit(a, b)


def edited(r, words, n):
    """``words`` with ``n`` words changed, dropped or inserted."""
    words = list(words)
    for _ in range(n):
        at, how = r.randrange(1, len(words) - 1), r.choice("cdi")
        words[at : at + (how != "i")] = [] if how == "d" else [f"zz{r.randrange(10**6)}"]
    return words


def test_near_passages_are_all_found(spark):
    r = random.Random(8)
    items = [(x.item_id, x.text) for x in table(spark, "/root/testdata/sf0.01", "eval_items").dropna().collect() if len(leakage.words_of(x.text)) >= 13]
    docs, want = [], set()
    for i in range(300):
        item, text = r.choice(items)
        words = leakage.words_of(text)
        at = r.randrange(len(words) - 12)
        docs.append((i, " ".join(["stir", "the", "pot"] + edited(r, words[at : at + 13], 2) + ["until", "done"])))
        want.add((i, item))
    df, held = spark.createDataFrame(docs, "d int, t string"), spark.createDataFrame(items, "i bigint, x string")
    got = {(x.d, x.i) for x in leakage.leaks(df, "d", "t", held, "i", "x", errors=2).collect()}
    assert want <= got
    # in parts: the same rows
    parted = leakage.leaks(df, "d", "t", held, "i", "x", errors=2, most_chars=5_000)
    assert {(x.d, x.i) for x in parted.collect()} == got and parted.count() == len(got)


def test_matches_equal_brute_force():
    r = random.Random(6)
    words = [f"w{i}" for i in range(12)]
    for errors in (0, 1, 2):
        items = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 18)))) for i in range(6)]
        pieces = leakage.Pieces(items, window=7, errors=errors)
        for _ in range(150):
            doc = [r.choice(words) for _ in range(r.randint(0, 25))]
            if r.random() < 0.7:
                source = r.choice(items)[1].split()
                part = source[r.randint(0, max(0, len(source) - 7)) :][: r.randint(5, 9)]
                for _ in range(r.randint(0, errors)):
                    part[r.randrange(len(part))] = r.choice(words)
                at = r.randint(0, len(doc))
                doc[at:at] = part
            want = set()
            for i, text in items:
                w = text.split()
                size = min(7, len(w))
                if size > errors and any(edit(w[k : k + size], doc) <= errors for k in range(len(w) - size + 1)):
                    want.add(i)
            got = set(pieces.matches(" ".join(doc)))
            assert {i for i in got if min(7, len(dict(items)[i].split())) > errors} == want


# reading level


def test_trees_learn_and_level_held_out(spark):
    import numpy as np

    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "level_labels")
    m = level.train(docs, "doc_id", "text", "source", labels, "level")
    assert m.accuracy > 0.95 and m.folds == 5
    x = np.random.default_rng(0).normal(size=(400, 3))
    y = (x[:, 0] > 0.3) * 2.0 + x[:, 1]
    assert np.mean((level.Trees().fit(x, y).predict(x) - y) ** 2) < 0.1 * y.var()


def test_english():
    assert level.is_english("The soup is on the table and it is hot") and not level.is_english("把锅烧热，放入少许油，中火慢慢煎至两面金黄。") and not level.is_english("Die Suppe steht auf dem Tisch und ist sehr heiss")


# queries against SQL


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_against_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("example_clean", "documents", "eval_items", "capacities"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.queries()[name](spark, sf)
    cols = ", ".join(df.columns)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, con.execute(f"SELECT {cols} FROM ({queries.oracle_sql()[name]})").fetchall()))


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_every_query_runs(spark, sf, name):
    assert queries.queries()[name](spark, sf).count() >= 0
