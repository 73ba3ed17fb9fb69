"""Operators on pages."""

import base64
import gzip
import hashlib
import random
import zlib

import pytest

from pairforge.llm import html_text, warc

PAGE = ("<html><head><title>T &amp; x</title><style>p{}</style><script>var a='</p>'</script></head><body>"
        "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><div class='ad'>Buy now.</div>"
        "<article><h1>Head &amp; line</h1><p><b>First&nbsp;part.<br>\n of it<p>Second   <i>part</i>.</p>"
        "<div class=\"comments\"><p>Nice read!</p></div></article><aside>See also</aside>"
        "<form><p>Your mail</p><button>Send</button></form><footer>&copy; site</footer>")


@pytest.fixture(scope="module")
def pages(spark):
    rnd = random.Random(3)
    words = lambda n: " ".join("".join(rnd.choices("abcdeio", k=4)) for _ in range(n)).capitalize()
    rows = [(i, f"http://h{i}.org/{i}", PAGE.replace("Second", words(30)), "x") for i in range(60)]
    rows += [(100, None, None, "x"), (101, "u", "", "x"), (102, "u", "<p>", "x"), (103, "u", "a < b > c &lt;", "x"),
             (104, "u", PAGE.replace("article>", "div>"), "x"), (105, "u", "<p>" + words(50_000), "x"),
             (None, "u", PAGE, "x"), (1, "http://h1.org/1", PAGE, "x")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")


def test_main_text(pages):
    rows = html_text.main_text(pages).collect()
    got = {r.page_id: r.text for r in rows}
    assert len(rows) == 67 and all(r.n_chars == len(r.text) for r in rows)
    for i in range(2, 60):
        lines = got[i].split("\n")
        assert lines[:2] == ["Head & line", "First part. of it"] and len(lines) == 3, lines
    assert got[100] == got[101] == got[102] == ""
    assert [b.text for b in html_text.leaf_blocks("a < b > c &lt;")] == ["a < b > c <"]
    assert len(got[105]) > 200_000
    # without a container the features of text and tags decide
    assert "First part. of it" in got[104] and "Home" not in got[104] and "site" not in got[104]


def test_main_text_without_labelled_pages(spark):
    rows = spark.createDataFrame([(1, "u", "<nav>menu</nav><p>Text one.</p><footer>x</footer>")],
                                 "page_id bigint, url string, html string")
    assert html_text.main_text(rows).collect()[0].text == "Text one."


def test_viterbi_is_the_best_path():
    rnd = random.Random(4)
    for _ in range(50):
        rows = [[f"f{rnd.randrange(6)}" for _ in range(3)] for _ in range(6)]
        model = html_text.ChainModel({f"f{k}": rnd.uniform(-2, 2) for k in range(6)}, rnd.uniform(-1, 1),
                                     [[rnd.uniform(-1, 1) for _ in range(2)] for _ in range(2)])

        def score(path):
            total = model.start * path[0] + sum(sum(model.weights[f] for f in r) for r, y in zip(rows, path) if y)
            return total + sum(model.moves[a][b] for a, b in zip(path, path[1:]))

        best = max((tuple((n >> k) & 1 for k in range(6)) for n in range(64)), key=score)
        assert score(tuple(model.decode(rows))) == pytest.approx(score(best))


@pytest.fixture(scope="module")
def captures(spark):
    same = "<p>same\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(i, f"http://www.hot.org/{i % 3}" if i % 2 else f"https://x{i}.com/a?b=2&a=1#f", f"<p>{i}é</p>")
            for i in range(300)]
    rows += [(k, "http://www.hot.org/s", same) for k in range(300, 330)]
    rows += [(400, None, None), (401, "bad url\r\nX: y", ""), (402, "http://e.org", None), (-5, "http://n.org", same),
             (None, "http://no.org", "x")]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)


def test_archives_round_trip(captures):
    rows, frame = captures
    pages = {p: (h or "").encode() for p, _, h in rows if p is not None}
    digest = {p: base64.b32encode(hashlib.sha1(b).digest()).decode() for p, b in pages.items()}
    head = {}
    for p, d in digest.items():
        head[d] = max(head.get(d, p), p)
    got = warc.archived(frame).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == {
        p: (len(b), digest[p], *(("response", None) if head[digest[p]] == p else ("revisit", head[digest[p]])))
        for p, b in pages.items()}
    assert len(got) == len(pages)
    ordered = [(r.urlkey, r.timestamp, r.page_id) for r in sorted(got, key=lambda r: (r.part, r.place))]
    assert ordered == sorted(ordered)


def test_archives_min_bytes_and_files(captures, tmp_path):
    rows, frame = captures
    path = str(tmp_path / "archives")
    got = {r.page_id: r for r in warc.archived(frame, min_bytes=1, path=path).collect()}
    assert {got[k].record_type for k in (400, 401, 402)} == {"response"}
    assert got[300].refers_to == 329 and got[-5].refers_to == 329
    r = got[7]
    data = gzip.decompress(next((tmp_path / "archives").glob(r.archive)).read_bytes())
    record = data[r["at"]:r["at"] + r["size"]]
    assert record.startswith(b"WARC/1.1\r\n") and record.endswith("<p>7é</p>\r\n\r\n".encode())
    assert zlib.crc32(record) and b"WARC-Target-URI: http://www.hot.org/1\r\n" in record


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html_text.main_text(none).count() == 0
    assert warc.archived(none).count() == 0


def test_loser_tree_merges():
    rnd = random.Random(5)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted(rnd.randrange(50) for _ in range(rnd.randrange(30))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_key():
    assert warc.url_key("HTTP://user@www.Example.org:80/A?b=2&a=1#x") == "org,example)/a?a=1&b=2"
    assert warc.url_key("https://e.org:8443") == "org,e:8443)/"
    assert warc.url_key(None) == ""


def test_archives_with_one_member_per_record(spark, tmp_path):
    rows = [(k, f"http://m.org/{k}", f"<p>{k}</p>") for k in range(20)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    records = [warc.warc_record(p, u, h.encode(), warc.payload_digest(h.encode()), None) for p, u, h in rows]
    with open(tmp_path / "members.warc.gz", "wb") as out:
        for record in records:
            out.write(gzip.compress(record + warc._END.encode()))
    got = warc.capture_index(spark, str(tmp_path), frame.select("page_id", "url")).collect()
    assert sorted(r.page_id for r in got) == list(range(20)) and {r.payload_bytes for r in got} == {8, 9}


def test_training_draws_among_pages_with_a_container(spark):
    plain = [(k, "u", "<div><p>a plain page without any container, number %d</p></div>" % k) for k in range(60)]
    held = [(1000 + k, "u", "<p>lead</p>" * 500 + "<article><p>The article's text, sentence %d.</p></article>" % k) for k in range(3)]
    frame = spark.createDataFrame(plain + held, "page_id bigint, url string, html string")
    taught = []
    original, html_text.train_chain = html_text.train_chain, lambda pages: taught.extend(pages) or html_text.DEFAULT
    try:
        html_text.learn(frame, sample=5)
    finally:
        html_text.train_chain = original
    assert len(taught) == 3 and all(1 in labels and len(labels) <= html_text.TRAIN_BLOCKS for _, labels in taught)
