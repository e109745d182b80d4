"""HTML text by host paths, tokenizer alignment, periodic runs: each against
a plain version of its contract, and on odd, empty and clashing input."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from fractions import Fraction
from html import unescape
from zlib import crc32

import numpy as np
import pytest

from recaudo.llm import html_text, period_runs, token_alignment
from recaudo.llm.common import read_table

SF = "/root/testdata/sf0.001"
CLASH = "label int, copy int, id string, __id int, __host string, score double, source string, rank int, text_sha256 string, winners string, runs int, pair int"


def clashing(df):
    names = [c.split() for c in CLASH.split(", ")]
    return df.selectExpr("*", *[f"cast(7 as {t}) as `{n}`" for n, t in names if n not in df.columns])


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------ html

def plain_article(html: str) -> str:
    inner = re.search(r"(?s)<article>(.*?)(?:</article>|$)", html).group(1)
    blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_pages_give_their_articles(spark):
    pages = read_table(spark, SF, "pages")
    want = sorted(((r.page_id, r.url, plain_article(r.html), len(plain_article(r.html))) for r in pages.collect()), key=repr)
    assert collected(html_text.op11_html_text(spark, SF)) == want
    assert collected(html_text.extract_text(clashing(pages))) == want


ARTICLE = "<p>{0} one has a fair number of words in it.</p><p>{0} two has <a href='/x'>a link</a> and more &lt;text&gt;.</p>"


def page(body: str) -> str:
    return f"<html><head><title>t</title></head><body><nav><a href='/'>Home</a></nav>{body}<footer>&copy; us</footer></body></html>"


def test_what_is_never_text():
    html = page("<header><h1>Site</h1></header><div id='cookie-notice'>We use cookies on this site, please do accept them all.</div>"
                "<div class='layout with-sidebar'><div class='post-42 entry'><header><h1>Title &amp; co</h1><p class='byline'>By X</p></header>"
                + ARTICLE.format("Paragraph") + "<ul><li>first<li>second</ul><table><tr><td>a<td>b</tr></table><p class='ad'>Buy now</p>"
                "<div class='share'>Share</div><aside>By the way</aside><form><label>Mail</label></form><script>var x='</p>';</script><style>p{}</style><p hidden>gone</p></div>"
                "<div id='comments'><article class='comment'><p>What a post, I have to say that I liked all of it very much.</p></article></div></div>"
                "<div class='sidebar'>Other things to read elsewhere</div>")
    assert html_text.extract(html, None) == ("Title & co\nParagraph one has a fair number of words in it.\nParagraph two has a link and more <text>.\nfirst\nsecond\na b")


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a < b and 3<4", "a < b and 3<4"), ("<p>one<p>two<br>three", "one\ntwo three"),
    ("<p>a&nbsp;&#8364; b &am", "a € b &am"), ("<!-- x --><p>y</p><!-- z", "y"), ("<div class=\"x><p>lost quote</p></div>", "lost quote"),
    ("<head><title>t</title><p>head never ends", "head never ends"), ("<p>cut off <a hre", "cut off"), ("<script>only", ""),
    ("<p> \t\r\n\x0b\x0c </p>", ""), ("<div><p>\U0001d11e</p></div>", "\U0001d11e")])
def test_small_and_broken_pages(html, text):
    assert html_text.extract(html, None) == text


def test_time_is_linear_in_broken_pages():
    begin = time.process_time()
    for part in ("<a ", '<a b="', "<", "<div>", "<div>x", "</x", "<!--", "<li>", "<pre>", "<div><td></td>", "</section><div>", '<p a="x" b=\'>', "<svg>", "<li><div><pre></li>"):
        html_text.extract(part * 40_000, ["x"])
    assert time.process_time() - begin < 30


def test_host_consensus_decides(spark):
    """On one host most pages have the article in div.text; the page whose
    unlabelled advert is longer than its article still gives the article."""
    rows = [(k, f"https://User@News.Example.com:80/{k}", page(f"<div class='box7'>Short.</div><div class='text{k}'>{ARTICLE.format(k)}</div>")) for k in range(5)]
    rows.append((5, "http://news.example.com/5", page("<div class='box8'>" + "<p>A very long offer of many things that nobody needs at all.</p>" * 9 + f"</div><div class='text5'>{ARTICLE.format(5)}</div>")))
    rows += [(6, None, page(f"<div class='box8'>{ARTICLE.format(6)}</div>")), (7, "not a url", None), (None, "http://news.example.com/", ""), (5, *rows[5][1:])]
    got = {(r.page_id, r.url): r for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = "{0} one has a fair number of words in it.\n{0} two has a link and more <text>."
    assert [got[k, rows[k][1]].text for k in range(7)] == [text.format(k) for k in range(7)]
    assert got[7, "not a url"].text == "" and got[None, "http://news.example.com/"].n_chars == 0
    alone = html_text.extract(rows[5][2], None)
    assert alone.startswith("A very long offer")
    votes = html_text.page_votes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    best = html_text.winning_paths(votes).collect()
    assert [(r.host, r.winners[0].path, r.winners[0].votes) for r in best] == [("news.example.com", "html>body>div.text", 5)]


def test_no_pages(spark):
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# ------------------------------------------------------------ alignment

def plain_alignment(texts):
    """Per text None or (n_a, n_b, groups, links), with the libraries' own encoders."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(token_alignment.BYTE_MODEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=token_alignment.PIECE_MODEL)
    letters = token_alignment._byte_letters()
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            yield None
            continue
        end_a, end_b = (list(np.cumsum([len(t) for t in x])) for x in (bytes_a, bytes_b))
        groups, links, i, j = [], [], 0, 0
        for e in sorted(set(end_a) & set(end_b)):
            k, m = end_a.index(e, i) + 1, end_b.index(e, j) + 1
            groups.append(",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])))
            links.append((ids_a[k - 1], ids_b[m - 1]))
            i, j = k, m
        yield len(ids_a), len(ids_b), groups, links


def plain_rows(docs):
    aligned = list(plain_alignment([t for _, t in docs]))
    count = Counter(p for x in aligned if x for p in x[3])
    most: dict = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(((i, x[0], x[1], len(x[2]), len(x[3]), sum(count[p] == most[p[1]] for p in x[3]), sum(count[p] for p in x[3]),
                    hashlib.sha256(";".join(x[2]).encode()).hexdigest()) if x else (i, 0, 0, 0, 0, 0, 0, "") for (i, _), x in zip(docs, aligned)), key=repr)


ODD = ["", None, " ", "\n\n\t ", "<|endoftext|><s></s><unk>", "a▁b", "naïve café €𝄞漢字かな", "\x00\x01\x7f", "a" * 3000, "ab " * 2000, "  two  spaces ", "don't", "١٢٣ ½", "é", " x y",
       "the cat", "the cat"]


def test_alignment_of_documents(spark):
    docs = read_table(spark, SF, "documents")
    assert collected(token_alignment.op12_token_alignment(spark, SF)) == plain_rows([(r.doc_id, r.text) for r in docs.collect()])


def test_alignment_of_odd_texts(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "the cat"), (3, "the cat sat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = token_alignment.align_tokenizers(clashing(docs), chunk_bytes=64, work=5, keep_groups=True)
    assert collected(got.drop("groups")) == plain_rows(rows)
    assert {r.doc_id: r.groups for r in got.collect()}[15] == ";".join(list(plain_alignment(["the cat"]))[0][2])
    none = docs.limit(0)
    assert token_alignment.align_tokenizers(none).collect() == []


def test_merge_path_cuts_equal_pieces():
    rng = random.Random(3)
    for _ in range(200):
        a, b = (np.array(sorted(rng.sample(range(1, 80), rng.randint(0, 40))), np.int64) for _ in "ab")
        work = rng.randint(1, 9)
        i, j = token_alignment.merge_cuts(a, b, work)
        assert all(x + y == min(k * work, len(a) + len(b)) for k, (x, y) in enumerate(zip(i, j)))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        assert [sum(1 for _, side in merged[:x + y] if side == 0) for x, y in zip(i, j)] == list(i)
        at_a, at_b = token_alignment.common_ends(a, b, work)
        assert list(a[at_a]) == list(b[at_b]) == sorted(set(a) & set(b))


def test_long_words_stay_cheap():
    aligner = token_alignment.Aligner(token_alignment.load_vocabularies())
    begin = time.process_time()
    row = aligner.chunk([1], ["ab1" * 60_000], False, 1 << 14)
    assert row["docs"][0]["n_links"] > 0 and time.process_time() - begin < 30


# ------------------------------------------------------------ runs

def plain_runs(words):
    found: dict = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_digest(doc_id, text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n, h = len(words), crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def repeating(rng, sizes=(1, 2, 3, 5, 8, 9, 12, 16, 17, 20, 33, 40, 70)):
    words = []
    for _ in range(rng.randint(0, 6)):
        k = rng.choice(sizes)
        base = [str(rng.randint(0, rng.choice([1, 2, 3, 50]))) for _ in range(k)]
        words += [base[i % k] for i in range(rng.randint(1, 7 * k))] + [str(rng.randint(0, 3)) for _ in range(rng.randint(0, 4))]
    return words


def test_runs_of_random_texts():
    rng = random.Random(1)
    for _ in range(150):
        texts = [[w.encode() for w in repeating(rng)] for _ in range(rng.randint(1, 8))]
        words, sizes = period_runs.numbered(texts)
        begin = np.concatenate([[0], np.cumsum(sizes + 1)])
        rows = period_runs.find_runs(words, sizes)
        for k, t in enumerate(texts):
            assert [(s - begin[k], n, q) for s, n, q in rows if begin[k] <= s < begin[k + 1]] == plain_runs(t)


def test_runs_of_documents(spark):
    docs = read_table(spark, SF, "documents").collect()
    short = {r.doc_id: plain_digest(r.doc_id, r.text) for r in docs if len((r.text or "").split()) < 1500}
    got = {r.doc_id: tuple(r) for r in period_runs.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs) and {k: got[k] for k in short} == short
    assert any(r[1] for r in short.values())


def test_runs_of_odd_texts(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(repeating(rng))) for k in range(60)]
    rows += [(None, "a a a a a a a"), (10, None), (11, ""), (12, " \n\x0b "), (13, "é" * 5), (14, "x x " * 9), (14, "x x " * 9), (15, "\x1c " * 8), (1016, "long " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((plain_digest(i, t) for i, t in rows if i != 1016), key=repr)
    found = period_runs.periodic_runs(clashing(docs), rewrite=period_runs.planted, block_words=50)
    assert collected(found.select("doc_id", "n_words").filter("doc_id <> 1016 or doc_id is null")) == sorted(((i, len([w for w in re.split("[\x20\x09-\x0d]+", t or "") if w])) for i, t in rows if i != 1016), key=repr)
    digests = {}
    for r in found.collect():
        runs = [tuple(x) for x in r.runs]
        digests.setdefault(r.doc_id, []).append((len(runs), hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(r.collapsed.encode()).hexdigest()))
    for w in want:
        assert (w[1], w[6], w[7]) in digests[w[0]]
    assert digests[1016][0][0] == 1
    assert period_runs.periodic_runs(docs.limit(0)).collect() == []
