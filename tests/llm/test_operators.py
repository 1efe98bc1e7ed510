"""The corpus operators against brute force on small inputs."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fedspark.llm import bpe, embedding_dedup, html_extract, language_id, line_dedup, mixing, quality_rules, queries, simhash, token_counts, url_filters
from fedspark.llm.components import connected_components, merged_components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **columns):
    rows = [(k, t, columns.get("lang", ["en"] * len(texts))[k], columns.get("source", ["a"] * len(texts))[k], len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def classes(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def odd_texts():
    return [None, "", " \n\t ", "a", "the the the", "x" * 20000, "<|endoftext|> and <|startoftext|>", "İΣΑΣ 'S I'LL", "é à 漢字 😀", "a\x1cb\xa0c"]


# ---- 1


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    t.encode_special_tokens = True
    return [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def edited(text, edits):
    for a, b, new in sorted(edits, reverse=True):
        text = text[:a] + new + text[b:]
    return text


def test_token_counts(spark):
    texts = [t for t in odd_texts() if t is None or len(t) < 1000] + ["mail me@example.org or +49 30 1234567\nline\nline\nkey 0123456789abcdef0123456789"]
    got = token_counts.count_with_edits(docs(spark, texts), queries.BYTE_TOKENIZER).orderBy("doc_id").collect()
    plain = [t or "" for t in texts]
    assert [r["n_tokens"] for r in got] == whole(plain)
    after = [edited(t, token_counts.cleaning_edits(t)) for t in plain]
    assert [r["n_tokens_edited"] for r in got] == whole(after)
    assert "[mail]" in after[-1] and after[-1].count("line") == 1
    assert token_counts.count_with_edits(empty(spark), queries.BYTE_TOKENIZER).count() == 0


def test_count_tree_after_any_edits():
    r, count = random.Random(3), token_counts.Counter(queries.BYTE_TOKENIZER)
    for _ in range(600):
        letters = r.choice(["ab '  \n", "a's're'll 1", "  \n\t x", "éa 😀'", "word word, 12 "])
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 60)))
        tree = token_counts.CountTree(text, count, leaf=r.choice([1, 2, 4]))
        for _ in range(r.randint(1, 6)):
            a = r.randint(0, len(text))
            b, new = r.randint(a, min(len(text), a + r.choice([0, 1, 5, 60]))), "".join(r.choice(letters) for _ in range(r.choice([0, 0, 1, 3, 20])))
            tree.replace(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text == text
            assert tree.n_tokens == sum(map(count, token_counts._pieces.findall(text)))


@pytest.mark.parametrize("text", ["x1a" + "abc1" * 250000, "a@" * 100000, "same line here\n" * 100000, "1 " * 100000, "0a" * 100000 + "g", "me@example.org " * 20000, "12345678 me@x.org\n" * 20000])
def test_counts_of_long_texts(text):
    import time

    began = time.perf_counter()
    count = token_counts.Counter(queries.BYTE_TOKENIZER)
    tree = token_counts.CountTree(text, count)
    tree.apply(token_counts.cleaning_edits(text))
    assert time.perf_counter() - began < 60  # a path that is quadratic takes hours
    after = edited_lines(text)
    assert tree.text == after and tree.n_tokens == token_counts.CountTree(after, count).n_tokens


def edited_lines(text):
    edits, out, at = token_counts.cleaning_edits(text), [], 0
    for a, b, new in edits:
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:]


def test_cleaning_edits():
    found = lambda text: [(text[a:b], new) for a, b, new in token_counts.cleaning_edits(text)]
    assert found("a.b+c@ex-am.ple.org, x@y and +49 (30) 123-456") == [("a.b+c@ex-am.ple.org", "[mail]"), ("+49 (30) 123-456", "[number]")]
    assert found("0123456789abcdef0123 0123456789abcdefghij aaaaaaaaaaaaaaaaaaaaaaaa") == [("0123456789abcdef0123", "[key]"), ("0123456789", "[number]")]
    assert found("one@x.org@y.org") == [("one@x.org", "[mail]")]
    assert found("a\n\na\n\nb") == [("\na", "")]


def test_an_edit_encodes_little_again():
    tree = token_counts.CountTree("some words " * 5000, token_counts.Counter(queries.BYTE_TOKENIZER))
    tree.replace(20000, 20004, "other")
    assert tree.encoded < 200 < tree.n_pieces


# ---- 2


def library(path, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    ids = t.encode(text, add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def hard_texts():
    r = random.Random(1)
    out = [t or "" for t in odd_texts()] + ["ab" * 3000, "!" * 4000, "the" * 2000 + "!!"]
    for _ in range(60):
        letters = r.choice(["abcdefghijklmnopqrstuvwxyz", "aeinrst", "ab", "!?.", "éèüñç", "a b\tc\n ", "the and ing"])
        out.append("".join(r.choice(letters) for _ in range(r.choice([5, 50, 3000]))))
    return out


@pytest.mark.parametrize("path", [queries.WORD_TOKENIZER, queries.BYTE_TOKENIZER])
def test_bpe_equals_the_library(path):
    engine = bpe.load(path)
    for text in hard_texts():
        ids, back = library(path, text)
        assert list(engine.encode(text)) == ids
        assert "".join(engine.decode(ids)) == back
        n, a, b = engine.digest(text)
        assert (n, a, b) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_bpe_tables(spark):
    df = docs(spark, odd_texts())
    rows = bpe.decode(bpe.encode(df, queries.BYTE_TOKENIZER), queries.BYTE_TOKENIZER).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert bpe.digests(empty(spark), queries.WORD_TOKENIZER).count() == 0


# ---- 3


def brute_links(rows, least=0.98):
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            unit[k] = a / np.linalg.norm(a)
    return [(i, j) for i in unit for j in unit if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least]


@pytest.mark.parametrize("part", [4096, 3])
def test_embedding_dedup(spark, part):
    r = np.random.default_rng(5)
    rows = []
    for _ in range(12):
        centre = r.standard_normal(16)
        rows += [(len(rows) + k, (centre + 0.06 * r.standard_normal(16)).tolist(), int(r.integers(2))) for k in range(6)]
    rows += [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(25)]
    for v in (None, [0.0] * 16, [float("nan")] * 16, [None, 1.0], [1.0, 1.0], [2.0, 2.0], [float("inf")] * 16):
        rows.append((len(rows), v, 0))
    rows.append((len(rows), rows[0][1], None))
    got = {x["vec_id"]: x for x in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), part=part).collect()}
    links = brute_links(rows)
    degree = collections.Counter(x for p in links for x in p)
    root = classes(len(rows), links)
    assert [(got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) for k in range(len(rows))] == [(degree[k], root[k], root[k] == k) for k in range(len(rows))]


def test_embedding_dedup_of_nothing(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# ---- 4


def brute_features(t):
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    marks = {i + d for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for d in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marks)


def test_quality_features(spark):
    r = random.Random(2)
    texts = [t or "" for t in odd_texts()] + ["a b c d e f a b c d e x y\n\nq\nq", "a " * 30] + [" ".join(r.choice("abcd") for _ in range(40)) for _ in range(40)]
    for t in texts:
        assert quality_rules.text_features(t)[:5] == brute_features(t)


def test_exact_bounds():
    want = sum(math.comb(50, i) * 0.1**i * 0.9 ** (50 - i) for i in range(3))
    assert abs(quality_rules.tail(2, 50, 0.1) - want) < 1e-12
    bound = quality_rules.upper_bound(2, 50, 0.05)
    assert abs(quality_rules.tail(2, 50, bound) - 0.05) < 1e-9
    assert quality_rules.choose_levels({"a": (1000, [0, 0, 60])}, 0.03, 0.05)["a"]["level"] == 1
    assert quality_rules.choose_levels({"a": (20, [0])}, 0.03, 0.05)["a"]["level"] is None


def test_quality_rules(spark):
    clean = " ".join(f"word{k}" for k in range(40))
    junk = " ".join(f"w{k}##$$%%" for k in range(40))
    texts = [clean] * 300 + [junk, "few words", None]
    out = quality_rules.filter_by_rules(docs(spark, texts), spark.createDataFrame([(k, 1) for k in range(300)] + [(None, 1), (300, None)], "doc_id long, good int"))
    kept = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert all(kept[k] for k in range(300)) and not kept[300] and not kept[301] and not kept[302]
    nothing = spark.createDataFrame([], "doc_id long, good int")
    assert quality_rules.filter_by_rules(docs(spark, texts), nothing).where("kept").count() == 301
    assert quality_rules.filter_by_rules(empty(spark), nothing).count() == 0


# ---- 5


def test_targets_are_shared_again():
    t = mixing.shared_targets([10, 100, 1000], [5, 2, 1])
    assert abs(sum(t) - 1110) < 1e-6 and t[0] == 30 and t[1] == 300
    assert mixing.shared_targets([0, 0], [5, 2]) == [0.0, 0.0]


def test_mixing(spark):
    r = random.Random(4)
    texts = ["w " * r.choice([1, 5, 20, 60, 300]) for _ in range(900)] + [None, "", " \n"]
    source = [r.choice(["a", "b", "c", None, "é"]) for _ in texts]
    rows = mixing.mix(docs(spark, texts, source=source)).collect()
    taken, target = collections.Counter(), {}
    for x in rows:
        assert x["__size"] == len(WORD.findall(x["text"] or "")) and 0 <= x["__copies"] <= 3
        taken[x["source"]] += x["__size"] * x["__copies"]
        target[x["source"]] = x["__target"]
    total = sum(x["__size"] for x in rows)
    order = sorted(target, key=lambda s: (s is None, s or ""))
    sizes = collections.Counter()
    for x in rows:
        sizes[x["source"]] += x["__size"]
    want = mixing.shared_targets([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))])
    assert all(abs(target[s] - w) < 1e-6 * total for s, w in zip(order, want))
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 5 for s in target)
    again = mixing.mix(docs(spark, texts, source=source).repartition(3)).collect()
    assert sorted((x["doc_id"], x["__copies"]) for x in again) == sorted((x["doc_id"], x["__copies"]) for x in rows)
    assert mixing.repeat(docs(spark, texts, source=source)).count() == sum(x["__copies"] for x in rows)
    assert mixing.mix(empty(spark)).count() == 0


# ---- 6


def page(body, host="a.example.org"):
    return (f"http://{host}/x", f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>")


def test_html_extraction(spark):
    pages = [
        page("<nav><a href=/>Home</a></nav><div class=ad>Buy</div><article><h1>One &amp; two</h1><p><b>First</b>  block<br>here<p>Second</p></article><aside>More</aside><footer>&copy;</footer>"),
        page("<nav><a href=/>Home</a></nav><article><h1>Three</h1><p>Text</p><ul><li>a<li>b</ul><section class=comments><p>Me too</p></section></article><footer>&copy;</footer>"),
        page("<header>Top</header><div id=cookie-notice>We use</div><form><label>Mail</label><input></form><div class=post><p>Body text</p></div>", "b.example.org"),
        (None, None),
        ("no scheme", "plain &lt;text"),
        page("<article><p>cut of"),
        page("<article><p>unclosed <!-- comment"),
    ]
    rows = [(k, u, h) for k, (u, h) in enumerate(pages)]
    got = {r["page_id"]: r for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = ["One & two\n\nFirst block here\n\nSecond", "Three\n\nText\n\na\n\nb", "Body text", "", "plain <text", "cut of", "unclosed"]
    assert [got[k]["text"] for k in range(len(pages))] == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def wrapped(pages):
    wrapper = None
    for x in pages:
        wrapper = html_extract.generalize(wrapper, html_extract.wrapper_of(html_extract.parse(x)))
    return wrapper


def test_wrappers_generalize():
    one = "<body><div id=c><h2>a</h2><p>x</p><h2>b</h2><p>y</p></div></body>"
    two = "<body><div id=c><h2>a</h2><p>z</p><table></table></div></body>"
    wrapper = wrapped([one, two])
    items = [(i[0], i[1], i[2]) for i in wrapper[5][0][5][0][5]]
    assert items == [("h2", False, True), ("p", False, True), ("table", True, False)]
    assert html_extract.loaded(html_extract.dumped(wrapper)) == wrapper


def test_template_text_is_left_out():
    make = lambda n: f"<body><div class=box>Same everywhere</div><div class=text>{n} is new</div></body>"
    assert html_extract.extract(make(9), wrapped(map(make, range(6)))) == "9 is new"
    shop = lambda n: f"<body><ul><li>Home<li>About us</ul><p>Our shop hours are nine to five</p><div class=text><h2>{n}</h2><p>Story {n}</p></div></body>"
    assert html_extract.extract(shop(3), None) == "Home\n\nAbout us\n\nOur shop hours are nine to five\n\n3\n\nStory 3"
    assert html_extract.extract(shop(3), wrapped(map(shop, range(50)))) == "3\n\nStory 3"


def test_text_of_few_pages_is_no_template():
    make = lambda n: f"<body><p>{'Quoted often' if n % 4 == 0 else f'own {n}'}</p><p>Story {n}</p></body>"
    assert html_extract.extract(make(0), wrapped(map(make, range(60)))) == "Quoted often\n\nStory 0"


def test_copies_and_siblings_are_no_template():
    plain = "<body><div class=text>The story</div><section>Its end</section></body>"
    assert html_extract.extract(plain, wrapped([plain] * 6)) == "The story\n\nIts end"
    lines = "<body>" + "<div>again</div>" * 5 + "</body>"
    assert html_extract.extract(lines, wrapped([lines])) == "\n\n".join(["again"] * 5)
    article = "<body><div class=box>Box</div><article><div>The story</div><address>A place</address></article></body>"
    assert html_extract.extract(article, wrapped([article] * 6)) == "The story\n\nA place"
    make = lambda n: f"<body><main><div>Everywhere</div><div class=text>{n} is new</div></main></body>"
    assert html_extract.extract(make(3), wrapped(map(make, range(6)))) == "Everywhere\n\n3 is new"
    box = lambda n: f"<body><div class=box>Same</div><div class=text>{n} is new</div></body>"
    assert html_extract.extract(box(1), wrapped([box(n) for n in range(4)] * 3)) == "Same\n\n1 is new"  # four contents
    assert html_extract.extract(box(1), wrapped([box(n) for n in range(5)] * 3)) == "1 is new"


def test_names_that_only_hold_a_word():
    body = "<body><article class='post comments-open'><p>Text</p><div class=share-price>12</div><div class=share-buttons>Share</div><div class='related posts'>More</div></article><article class=comment-12>Me too</article></body>"
    assert html_extract.extract(body, None) == "Text\n\n12"


def test_deep_and_wide_pages(spark):
    deep = "<body>" + "<div>" * 20000 + "<p>inside</p>" + "</div>" * 20000 + "</body>"
    odd = "<body>" + "<x>" * 20000 + "<p>inside</p>" + "</y>" * 20000 + "</body>"
    wide = "<body>" + "".join(f"<div class=c{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k // 100 % 10]}>t{k}</div>" for k in range(1000)) + "</body>"
    long = "<body><article><p>" + "word " * 200000 + "</p></article></body>"
    rows = [(k, "http://h.example.org/", x) for k, x in enumerate([deep, deep, odd, wide, wide.replace("=ca", "=za"), long])]
    rows += rows[:1]
    got = sorted((r["page_id"], r["text"]) for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert [k for k, _ in got] == [0, 0, 1, 2, 3, 4, 5]
    assert [t for _, t in got][:4] == ["inside"] * 4 and got[6][1] == ("word " * 200000).strip()
    assert got[4][1].count("\n\n") == 999


def test_html_extraction_of_a_whole_table(spark):
    import html as entities

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in queries.op6_html_extract(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows) == 250
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)
        assert article is not None
        plain = entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"<!--.*?-->", "", article[1], flags=re.S)))
        assert "".join(plain.split()) == "".join(got[r["page_id"]].split())


# ---- 7


def brute_lines(texts, k=10, least=0.8):
    known = {}
    for t in texts:
        for line in (t or "").split("\n"):
            if WORD.search(line):
                known.setdefault(line, len(known))
    sets = [frozenset(b[i : i + k] for i in range(max(len(b) - k + 1, 1))) for b in (x.encode() for x in known)]
    links = [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    root, seen, out = classes(len(sets), links), set(), []
    for t in texts:
        kept = []
        for line in (t or "").split("\n"):
            if WORD.search(line):
                if root[known[line]] in seen:
                    continue
                seen.add(root[known[line]])
            kept.append(line)
        out.append(None if t is None else "\n".join(kept))
    return out


def test_line_dedup(spark):
    r = random.Random(6)
    base = [" ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(30)) for _ in range(12)]
    texts = [None, "", "\n\n", "short", "short\nshort\n \nother", "x" * 70000 + "\nshort"]
    for _ in range(120):
        lines = []
        for _ in range(3):
            words = r.choice(base).split()
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                words[r.randrange(len(words))] = r.choice(["new", "word", "here"])
            lines.append(" ".join(words))
        texts.append("\n".join(lines))
    got = {x["doc_id"]: x for x in line_dedup.dedup_lines(docs(spark, texts)).collect()}
    want = brute_lines(texts)
    assert [got[k]["__text"] for k in range(len(texts))] == want
    assert all(got[k]["__kept"] == sum(bool(WORD.search(x)) for x in (w or "").split("\n")) for k, w in enumerate(want))
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_line_dedup_compares_buckets_of_two(spark):
    r, texts = random.Random(8), []
    for _ in range(150):  # a line, a near copy of it and one of its template, of which any may have the least hash
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(30)]
        near = words[:-1] + ["changed"]
        template = words[:16] + ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(14)]
        texts += [" ".join(words), " ".join(near), " ".join(template)]
    got = {x["doc_id"]: x["__text"] for x in line_dedup.dedup_lines(docs(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_lines(texts)


def test_line_dedup_marks_tell_a_group_of_near_copies_apart(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 8)))
    base, lines = [word() for _ in range(60)], ["again and again and again and again", "y" * 70_000, "y" * 70_001]
    for _ in range(90):  # about half of the pairs lie below the threshold, most of them just below
        words = list(base)
        for _ in range(r.randint(1, 5)):
            words[r.randrange(60)] = word()
        lines.append(" ".join(words) + r.choice(["", " and so on and so on and so on"]))
    texts = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    profiles = line_dedup._profiles(texts, 10)
    sets = [frozenset(b[i : i + 10] for i in range(max(len(b) - 9, 1))) for b in (x.encode() for x in lines)]
    assert {x["id"]: x["n"] for x in profiles.collect()} == {k: None if k in (1, 2) else len(s) for k, s in enumerate(sets)}
    both = line_dedup._side(profiles, "x_").join(line_dedup._side(profiles, "y_"), F.expr("x_id < y_id"))
    may = {(x["x_id"], x["y_id"]) for x in both.where(line_dedup._may_reach(0.8)).collect()}
    pairs = [(i, j) for j in range(len(sets)) for i in range(j)]
    reach = lambda least: {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])}
    links = reach(0.8)
    assert links <= may
    assert len(reach(0.72) - links) > 500 and len({p for p in may if p[0] > 2} - reach(0.77)) == 0


def test_line_dedup_treats_equal_rows_alike(spark):
    df = docs(spark, ["one line here\nanother line"])
    both = df.union(df).withColumnRenamed("lang", "pos").withColumnRenamed("source", "line")
    assert {x["__kept"] for x in line_dedup.dedup_lines(both).collect()} == {2}
    assert line_dedup.without_repeats(both).columns == both.columns


# ---- 8


def brute_print(t):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = WORD.findall((t or "").translate(lower))
    parts = [" ".join(w[k : k + 4]) for k in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    counts = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(parts))


def test_simhash(spark):
    r = random.Random(7)
    texts = odd_texts()
    for _ in range(6):
        words = [f"Word{r.randrange(500)}" for _ in range(150)]
        for _ in range(25):
            copy = list(words)
            for _ in range(r.choice([0, 1, 2])):
                copy[r.randrange(len(copy))] = "new"
            texts.append(" ".join(copy))
    prints = [brute_print(t) for t in texts]
    root = classes(len(texts), [(i, j) for j in range(len(texts)) for i in range(j) if (prints[i] ^ prints[j]).bit_count() <= 4])
    got = {x["doc_id"]: x for x in simhash.near_duplicates(docs(spark, texts)).collect()}
    assert [got[k]["fingerprint"] for k in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[k]["component_id"] for k in range(len(texts))] == root
    kept = sorted(x["doc_id"] for x in simhash.keep_one(docs(spark, texts)).collect())
    assert kept == sorted(set(root))
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_keep_one_of_repeated_and_missing_ids(spark):
    text = lambda seed: " ".join(f"w{seed}x{k}" for k in range(40))
    rows = [(2, text(1)), (5, text(1)), (5, text(2)), (5, text(2)), (5, text(3)), (None, text(4)), (None, text(4)), (None, text(3)), (None, text(5)), (7, None), (None, None)]
    df = spark.createDataFrame([(k, t, "en", "a", len(t or "")) for k, t in rows], DOCS)
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    want = [(2, text(1)), (5, text(2)), (5, text(3)), (None, text(4)), (None, text(5)), (7, None)]
    assert sorted(((x["doc_id"], x["text"]) for x in out.collect()), key=str) == sorted(want, key=str)


def test_simhash_parts_of_a_run(spark):
    r = random.Random(8)
    centre = r.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(400)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in fps]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), part=20)
    roots = {x["node"]: x["root"] for x in connected_components(links).collect()}
    want = classes(len(fps), [(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= 4])
    names = [roots.get(s[0], s[0]) for s in signed]
    assert len(set(names)) == len(set(want)) and len(set(zip(names, want))) == len(set(want))


def test_any_close_pair_shares_a_block():
    masks, r = simhash.block_masks(7, 4), random.Random(9)
    for _ in range(2000):
        a = r.getrandbits(64)
        b = a ^ sum(1 << x for x in r.sample(range(64), 4))
        assert any(a & m == b & m for m in masks)


def test_components(spark):
    r = random.Random(10)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(None, 3), (7, 7)]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = classes(500, [e for e in edges if None not in e])
    assert all(root[k] == v for k, v in got.items()) and set(got) == {x for a, b in edges if a is not None and a != b for x in (a, b)}


def test_components_of_long_chains_take_few_rounds(spark, monkeypatch):
    from fedspark.llm import components

    passes = []
    chased = components._chased
    monkeypatch.setattr(components, "_chased", lambda *a: passes.append(1) or chased(*a))
    r = random.Random(12)
    names = list(range(20000, 30000))
    r.shuffle(names)
    chain = [(k, k + 1) for k in range(10000)] + list(zip(names, names[1:]))
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len(got) == 20001 and {got[k] for k in range(10001)} == {0} and {got[k] for k in names} == {20000}
    assert len(passes) < 20


def test_components_go_on(spark):
    links = lambda rows: spark.createDataFrame(rows, "a long, b long")
    roots = connected_components(links([(1, 2), (5, 6), (8, 9)]))
    got = {x["node"]: x["root"] for x in merged_components(roots, links([(2, 6), (3, 4), (6, 5)])).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 3: 3, 4: 3, 8: 8, 9: 8}
    assert connected_components(links([])).count() == 0


# ---- 9


def test_url_parts_and_rules(spark):
    urls = [None, "no-scheme.com/en/", "http://Example.COM/en/x?q#f", "https://www.example.com/en/", "http://a.www.example.com/en/", "http://x.net/es/1", "http://net/fr/", "http://y.com", "http://z.org/a/b?c", "http://badexample.com/en/", "http://u.com?x/en/"]
    got = {r["page_id"]: r for r in url_filters.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), spark.createDataFrame([], "page_id long, bad int"), queries.URL_RULES).collect()}
    want = [("", "", None), ("", "", None), ("example.com", "/en/x", "example.com/en/"), ("www.example.com", "/en/", "www.example.com/en/"), ("a.www.example.com", "/en/", "www.example.com/en/"), ("x.net", "/es/1", "net/es/"), ("net", "/fr/", "net/fr/"), ("y.com", "", None), ("z.org", "/a/b", None), ("badexample.com", "/en/", "com/"), ("u.com", "", None)]
    assert [(got[k]["host"], got[k]["path"], got[k]["rule"]) for k in range(len(urls))] == want
    assert [got[k]["verdict"] for k in range(len(urls))] == ["allow", "allow", "block", "allow", "allow", "block", "block", "allow", "allow", "allow", "allow"]


def test_url_reputation(spark):
    pages = [(k, f"http://{'bad' if k % 2 else 'good'}.site{k % 2}.org/{k}") for k in range(80)] + [(1000, "http://new.site1.org/"), (1001, "http://new.site0.org/")]
    outcomes = [(k, k % 2) for k in range(60)] + [(None, 1), (5, None)]
    out = url_filters.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int"), [])
    got = {r["page_id"]: r["verdict"] for r in out.collect()}
    assert all(got[k] == ("block" if k % 2 else "allow") for k in range(80))
    assert got[1000] == "block" and got[1001] == "allow"


def test_url_query_equals_its_sql(spark):
    from oracle import same

    assert same(queries.op9_url_filters(spark, SF), queries.oracle_sql()["op9_url_filters"], SF) is None


# ---- 10


def test_language_id_on_held_out_documents(spark):
    rows = queries.op10_language_id(spark, SF).alias("p").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) and len(rows) > 20
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_cases(spark):
    texts = [None, "", "12 34 !!", "the cat and the dog"] + ["the cat and the dog are here now"] * 20 + ["der hund und die katze sind jetzt da"] * 20
    df = docs(spark, texts, lang=["en"] * 24 + ["de"] * 20)
    got = {r["doc_id"]: r for r in language_id.predictions(df).collect()}
    assert [got[k]["lang_pred"] for k in range(3)] == ["und"] * 3 and got[0]["score"] == 0
    assert got[3]["lang_pred"] == "en" and got[40]["lang_pred"] == "de"
    assert language_id.predictions(empty(spark)).count() == 0
    unlabelled = docs(spark, texts, lang=[None] * len(texts))
    assert {r["lang_pred"] for r in language_id.predictions(unlabelled).collect()} == {"und"}


def test_language_id_learns_from_two_thousand(spark, monkeypatch):
    monkeypatch.setattr(language_id, "fit", lambda x, langs: langs)
    df = spark.range(3200).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id % 2 = 0, 'en', 'de') as lang")
    langs = language_id.train(df)
    assert langs.count("en") == langs.count("de") == 1000


# ---- all


def test_extra_columns_with_clashing_names(spark):
    taken = ["__size", "__key", "__draw", "__target", "__copies", "__of", "__id", "__at", "at", "body", "own", "__text", "__lines", "__found", "found", "__lang", "c0", "draw"]
    df = docs(spark, ["the cat and the dog are here now\nanother line"] * 3 + ["der hund und die katze sind jetzt da", None], lang=["en"] * 3 + ["de"] * 2)
    wide = df
    for k, name in enumerate(taken):
        wide = wide.withColumn(name, df["doc_id"] + k)
    mixed = mixing.mix(wide)
    assert set(mixed.columns) == {*wide.columns, "__source_size", "__rate"}
    got = {(r["doc_id"], r["__copies"], r["__key"], r["c0"]) for r in mixed.collect()}
    want = {(r["doc_id"], r["__copies"], r["doc_id"] + 1, r["doc_id"] + 16) for r in mixing.mix(df).collect()}
    assert got == want
    again = mixing.repeat(wide)
    assert again.columns == wide.columns and all(r["__size"] == r["doc_id"] for r in again.collect())
    named = language_id.identify(wide, language_id.train(wide))
    assert all(r["found"] == r["doc_id"] + 14 and r["__lang"] in ("en", "de", "und") for r in named.collect())
    assert simhash.keep_one(wide).columns == wide.columns
    assert sorted(r["doc_id"] for r in simhash.keep_one(wide).collect()) == [0, 3, 4]
    kept = {r["doc_id"]: (r["__text"], r["__kept"], r["own"]) for r in line_dedup.dedup_lines(wide).collect()}
    assert kept[0] == ("the cat and the dog are here now\nanother line", 2, 10) and kept[1] == ("", 0, 11) and kept[4] == (None, 0, 14)


def test_repeated_rows_come_out_repeated(spark):
    text = "the cat and the dog are here now with ten words or more"
    df = docs(spark, [text, "other words stand here and they are not the same at all"])
    both = df.union(df)
    rows = lambda out: sorted(map(str, out.collect()))
    labels = spark.createDataFrame([], "doc_id long, good int")
    for run in (
        lambda d: token_counts.count_with_edits(d, queries.BYTE_TOKENIZER), lambda d: bpe.digests(d, queries.WORD_TOKENIZER), lambda d: quality_rules.filter_by_rules(d, labels), simhash.near_duplicates,
        lambda d: language_id.identify(d, language_id.train(df)), lambda d: line_dedup.dedup_lines(d),
    ):
        assert rows(run(both)) == sorted(rows(run(df)) * 2)
    vectors = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)], "vec_id long, embedding array<double>, label int")
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(vectors).collect()) == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]
    pages = spark.createDataFrame([(1, "http://a.com/x")] * 2, "page_id long, url string")
    outcomes = spark.createDataFrame([], "page_id long, bad int")
    assert url_filters.filter_urls(pages, outcomes, queries.URL_RULES).count() == 2
    assert url_filters.filter_urls(pages.limit(0), outcomes, queries.URL_RULES).count() == 0


def test_passes_grow_with_the_vectors():
    assert embedding_dedup.plan_passes(50_000) == (24, 16)
    for n in (10**6, 10**8, 10**9):
        passes, prefix = embedding_dedup.plan_passes(n)
        equal = (1 - math.acos(0.98) / math.pi) ** prefix
        assert (1 - equal) ** passes <= 5e-5 and n / 2**prefix <= 4


def test_embedding_recall_at_the_threshold(spark):
    r, rows = np.random.default_rng(9), []
    for _ in range(500):  # pairs just above the similarity, the hardest to bring together
        a, b = r.standard_normal(32), r.standard_normal(32)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(len(rows), a.tolist(), 0), (len(rows) + 1, (0.9801 * a + math.sqrt(1 - 0.9801**2) * b).tolist(), 0)]
    links = brute_links(rows)
    got = {x["vec_id"]: x["n_links"] for x in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert len(links) == 500 and sum(got.values()) >= 0.99 * 2 * len(links)
    assert all(got[k] <= 1 for k in got)


def test_bpe_words_share_their_tables(monkeypatch):
    """the tables of the decoder are made once, not for each different word or text."""
    engine, made = bpe.Transducer(queries.WORD_TOKENIZER), []
    monkeypatch.setattr(bpe, "byte_symbols", lambda: made.append(1) or list(map(chr, range(256))))
    words = [f"word{k} " + chr(0xE9) * (k % 5) for k in range(300)]
    n, ids, text = engine.digest(" ".join(words))
    assert not made
    found = list(engine.encode(" ".join(words)))
    assert n == len(found) and ids == hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest()
    assert text == hashlib.sha256("".join(engine.decode(found)).encode()).hexdigest()


def test_alignments_are_exact_at_any_length():
    """long sequences too are aligned by a longest common subsequence, in the way of the whole table."""
    rng = random.Random(6)
    for n, m, kinds in [(700, 650, 3), (600, 700, 300), (40, 30, 2), (3, 900, 2), (1, 1, 2)]:
        a, b = ([[f"s{rng.randrange(kinds)}", k] for k in range(size)] for size in (n, m))
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in reversed(range(n)):
            for j in reversed(range(m)):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
        found = html_extract._aligned(a, b)
        assert sum(1 for p, q in found if p and q) == best[0][0]
        assert [p for p, _ in found if p] == a and [q for _, q in found if q] == b
        assert all(p[0] == q[0] for p, q in found if p and q)
    a = [["z"], *([f"s{k}"] for k in range(600))]
    assert sum(1 for p, q in html_extract._aligned(a, [*a[1:], ["z"]]) if p and q) == 600


def test_bpe_merges_a_pre_token_once():
    """Words that differ by capitals and marks share the merges of their pre-tokens, and Latin letters need no call
    of the library; ids and text are the library's."""
    engine, merged = bpe.Transducer(queries.WORD_TOKENIZER), []
    for name in ("merged", "stream"):
        act = getattr(engine.table, name)
        setattr(engine.table, name, lambda x, act=act: merged.append(1) or act(x))
    engine.digest("Gebärden gebärden. GEBÄRDEN, (gebärden)")
    assert len(merged) == 5  # the word and four runs of marks
    latin = [chr(c) for c in range(0x21, 0x250)]
    words = [*(f"{a}{b}x{a}" for a, b in zip(latin, latin[7:])), "İI", "ŸẞſŉĲ", "it's", "IT'S''s", "aª1²½_", "é" * 700, "éA", "\x1ca\x85b\xa0c", "Ʌb"]
    for text in [" ".join(words), *words]:
        ids, back = library(queries.WORD_TOKENIZER, text)
        assert engine.digest(text) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()), text
        assert list(engine.encode(text)) == ids


def test_language_id_sends_only_counts_over_zero(spark, monkeypatch):
    """The driver gets 6 bytes for each different gram, and the same matrix in the same order."""
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda x, langs: seen.append((x.copy(), langs)))
    texts = [f"the {w} and the dog" for w in ("cat", "cow", "hen", "cat")] + ["der hund und die katze", "x" * 70000 + "yz"]
    df = spark.range(40).selectExpr("id as doc_id", f"element_at(array({', '.join(map(repr, texts))}), cast(id % 6 as int) + 1) as text", "if(id % 6 < 4, 'en', 'de') as lang")
    sent, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: [sent.append(r) or r for r in collect(self)])
    language_id.train(df)
    (x, langs), = seen
    assert max(sum(len(v) for v in r if isinstance(v, (bytes, bytearray))) for r in sent) < 1000
    rows = [(r["lang"], language_id.counts(r["text"]).astype(np.float32).tobytes()) for r in collect(df.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))]
    assert [(n, v.tobytes()) for n, v in zip(langs, x)] == sorted(rows)
