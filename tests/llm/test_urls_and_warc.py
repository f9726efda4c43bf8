import hashlib
import html
import random
import sys
import urllib.parse
import zlib
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from barloom.llm.queries import ORACLE, op4_url_filter  # noqa: E402
from barloom.llm.urls import judge_pages  # noqa: E402
from barloom.llm.warc import EMPTY_MEMBER, archive_pages, index, member, members_of, normalise, read_record, whole_records  # noqa: E402
from oracle_compare import compare  # noqa: E402
from plain import table  # noqa: E402

PAGE = "page_id long, url string, html string, host string, verdict string, component string"


def judged(spark, rows):
    frame = table(spark, [(i, u, h, "x", "x", "x") for i, (u, h) in enumerate(rows)], PAGE)
    found = {r["page_id"]: r for r in judge_pages(frame).collect()}
    assert len(found) == len(rows)
    return [found[i] for i in range(len(rows))]


def test_rules(spark):
    cases = [
        ("https://a.NET/x", "a.net", "/x", "net/", "block"), ("https://net", "net", "", None, "allow"), ("http://x.example.net/en/1?q", "x.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://notexample.net/en/1", "notexample.net", "/en/1", "net/", "block"), ("http://example.com/de/#f", "example.com", "/de/", "example.com/de/", "block"),
        ("http://example.com/DE/", "example.com", "/DE/", None, "allow"), ("http://w.org/fr/", "w.org", "/fr/", "org/fr/", "allow"), ("//a.net/x", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("", "", "", None, "allow"), ("x://y://a.net/", "y:", "//a.net/", None, "allow"), ("http://a.net:80/", "a.net:80", "/", None, "allow"), ("http://a.b\n.net/\n", "a.b\n.net", "/\n", "net/", "block"),
    ]
    for got, want in zip(judged(spark, [(c[0], None) for c in cases]), cases, strict=True):
        assert tuple(got[c] for c in ("host", "path", "rule", "verdict")) == want[1:]


def canonical(url):
    return f'<html><LINK rel="canonical" href="{url}"><body>'


def test_decisions_pass_to_aliases(spark):
    rows = [
        ("http://one.com/a", canonical("http://bad.net/a")),  # 0: its canonical address is blocked
        ("http://two.com/a?utm_source=x", '<meta http-equiv=refresh content="0; url=http://one.com/a/">'),  # 1: reaches 0
        ("http://three.com/", canonical("http://good.example.net/en/1")),  # 2: allowed and blocked aliases: allow wins
        ("http://four.net/x", canonical("http://three.com")),  # 3: blocked by its own rule
        ("http://five.com/p/q", canonical("r")),  # 4, 5: relative to the folder
        ("http://five.com/p/r", canonical("//bad.net/z")),
        ("http://six.com/p", None),
        ("http://one.com/a#frag", None),  # 7: another spelling of 0
        ("http://seven.com", canonical("/k")),  # 8, 9
        ("https://seven.com/k?sessionid=1&utm_x=2", canonical("http://example.com/de/x")),
    ]
    assert [r["verdict"] for r in judged(spark, rows)] == "block block allow block block block allow block block block".split()


def test_targets_as_pages_write_them(spark):
    rows = [
        ("http://a.com/p/q?x=1&y=2", None),  # 0: named by 1
        ("http://a.com/n", canonical("http://a.com/p/q?x=1&amp;y=2")),
        ("http://a.com/p/../p/./q/?x=1&y=2", canonical("http://bad.net/")),  # 2: another spelling of 0, blocked with it
        ("http://b.com/u/v/w", canonical("../k")), ("http://b.com/u/k", canonical("//bad.net/k")),  # 3, 4
        ("http://c.com/u/v", canonical("./k")), ("http://c.com/u/k", canonical("//bad.net/k")),  # 5, 6
        ("http://d.com/u?page=1", canonical("?page=2")), ("http://d.com/u?page=2", canonical("//bad.net/k")),  # 7, 8
        ("http://e.com/u", canonical("#top")), ("http://e.com/u/#top", None),  # 9, 10: itself alone
        ("http://f.com/", '<link href=http://bad.net/ rel="alternate canonical">'), ("http://g.com/", "<link rel=canonical href='http://bad.net/'/>"),  # 11, 12
        ("http://h.com/", '<link rel="canonicals" href="http://bad.net/">'), ("http://i.com/", canonical("mailto:x@bad.net")),  # 13, 14
        ("http://j.com", canonical("x")), ("http://j.com/x", canonical("http://example.com/en/../de/1")),  # 15, 16
    ]
    want = [*["block"] * 9, *["allow"] * 2, *["block"] * 2, *["allow"] * 2, *["block"] * 2]
    assert [r["verdict"] for r in judged(spark, rows)] == want


def plain_address(url):
    whole, _, query = url.partition("#")[0].partition("?")
    scheme, _, rest = whole.partition("://")
    host, slash, path = rest.partition("/")
    return host + urllib.parse.urlsplit(urllib.parse.urljoin(f"http://{host}/", slash + path)).path.rstrip("/") + (f"?{query}" if query else "")


def test_links_against_union_find(spark, tmp_path):
    """Pages that link at random, against resolution by the standard library and plain union-find, and against SQL."""
    rng = random.Random(12)
    hosts = ["a.com", "b.com", "x.net", "example.net", "c.org", "example.com"]
    folders = ["/", "/de/", "/en/", "/u/v/", "/fr/w/"]
    paths = [f"http://{h}{f}{n}" for h in hosts for f in folders for n in ("1", "2?p=1&q=2")]
    rows = []
    for i in range(150):
        kind = rng.randrange(6)
        target = [rng.choice(paths), "../1", "./2?p=1&q=2", "?p=3", rng.choice(["/de/1", "/u/../en/1", "//x.net/1"]), None][kind]
        if target and rng.random() < 0.5:
            page = f'<link rel="nofollow canonical" href="{target.replace("&", "&amp;")}">' if kind % 2 else f"<meta http-equiv='refresh' content=\"1; url={target}\">"
        else:
            target, page = None, "<p>no link</p>"
        rows.append((i, rng.choice(paths), page, target))
    top = {}

    def find(a):
        while top.setdefault(a, a) != a:
            a = top[a]
        return a

    said = {}
    for _, url, _, target in rows:
        ends = [url, *([urllib.parse.urljoin(url, html.unescape(target))] if target else [])]
        top[find(plain_address(ends[0]))] = find(plain_address(ends[-1]))
        for end in ends:
            host, _, path = end.partition("://")[2].partition("/")
            rules = [(len(h + p), v) for v, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")) if f".{host}".endswith(f".{h}") and f"/{path}".startswith(p)]
            if rules:
                said[end] = max(rules)[1]
    groups = {}
    for url, verdict in said.items():
        groups.setdefault(find(plain_address(url)), set()).add(verdict)
    want = {}
    for i, url, _, _ in rows:
        group = groups.get(find(plain_address(url)), {"allow"})
        want[i] = said.get(url, "allow" if "allow" in group else "block")
    assert set(want.values()) == {"allow", "block"} and len(groups) > 3
    frame = table(spark, [(i, u, h) for i, u, h, _ in rows], "page_id long, url string, html string")
    assert {r["page_id"]: r["verdict"] for r in judge_pages(frame).collect()} == want
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    problem, n = compare(spark, con, op4_url_filter, ORACLE["op4_url_filter"], str(tmp_path))
    assert not problem and n == len(rows)


def test_a_hub_of_aliases(spark):
    rows = [(f"http://m{i}.com/", canonical("http://hub.net/")) for i in range(200)]
    assert {r["verdict"] for r in judged(spark, rows)} == {"block"}
    assert judge_pages(table(spark, [], PAGE)).count() == 0


def test_round_trip(spark, tmp_path):
    rng = random.Random(4)
    big = "".join(rng.choice("abcdé \r\n") for _ in range(30_000))
    same = "z" * 1000
    rows = [
        (1, "http://a/1", None), (2, None, ""), (3, "http://a/\r\nX: y", "short"), (4, "u", "short"), (5, "u5", same), (6, "u6", same), (7, "u7", same + "\r\n\r\n"), (8, "u8", big),
        (9, "u9", big), (None, "u0", same), (11, "u11", "WARC/1.1\r\nContent-Length: 5\r\n\r\n\x00end"), (12, "é", "\r\n"), (6, "again", same), (13, "u", "é" * 500), (14, "u", "é" * 500),
    ]
    frame = table(spark, [(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    found = archive_pages(frame, str(tmp_path / "out")).collect()
    assert len(found) == len(rows)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        kept = max((j for j, _, g in rows if (g or "") == (h or "") and j is not None), default=None)
        again = len(data) >= 1000 and sum((g or "") == (h or "") for _, _, g in rows) > 1 and i != kept
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", kept if again else None))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))
    # Every record can be read by its offset and length alone, and the whole file by any gzip reader.
    for r in found:
        record = read_record((tmp_path / "out" / "archives" / r["file"]).read_bytes(), r["offset"], r["length"])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert archive_pages(frame.limit(0)).count() == 0


def test_members():
    small, large = b"WARC/1.1 x" * 9, b"y" * ((1 << 24) + 3)
    data = member(small) + member(large)
    assert data.endswith(EMPTY_MEMBER) and EMPTY_MEMBER[-1] == 0 and member(small)[-1] == 0
    assert [record for _, _, record in members_of(data)] == [small, large]
    with pytest.raises(ValueError):
        list(members_of(data[:-30]))


def test_foreign_archives(spark, tmp_path):
    """A file with one stream, and one whose records already are members."""
    records = [f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {n}\r\n\r\n{'x' * n}\r\n\r\n".encode() for i, n in enumerate((0, 5, 70_000))]
    pack = lambda data: (c := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(data) + c.flush()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "whole.warc.gz").write_bytes(pack(b"".join(records)))
    (tmp_path / "in" / "members.warc.gz").write_bytes(b"".join(pack(r) for r in records))
    normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    found = index(spark, str(tmp_path / "out")).collect()
    assert sorted((r["archive"], r["page_id"]) for r in found) == [(a, i) for a in ("members.warc.gz", "whole.warc.gz") for i in range(3)]
    for name in ("whole.warc.gz", "members.warc.gz"):
        (file,) = (tmp_path / "out" / f"archive={name}").glob("part=0/part-*.txt")
        assert [record for _, _, record in members_of(file.read_bytes())] == records
    with pytest.raises(ValueError):
        list(whole_records(b"".join(records)[:-9].split(b"\r\n")))
    with pytest.raises(ValueError):
        list(whole_records([b"no record", b""]))


def test_a_large_archive_becomes_files_of_bounded_size(spark, tmp_path):
    rng, limit = random.Random(9), 50_000
    sizes = [rng.randrange(100, 9000) for _ in range(200)] + [3 * limit, 10]
    blocks = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n)) for n in sizes]
    records = [f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(b)}\r\n\r\n{b}\r\n\r\n".encode() for i, b in enumerate(blocks)]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a+b c.warc.gz").write_bytes(pack.compress(b"".join(records)) + pack.flush())
    normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"), limit)
    found = index(spark, str(tmp_path / "out")).collect()
    assert sorted(r["page_id"] for r in found) == list(range(len(records))) and {r["archive"] for r in found} == {"a+b c.warc.gz"}
    files = {r["file"]: (tmp_path / "out" / r["file"]).read_bytes() for r in found}
    assert len(files) > 10 and sorted(map(len, files.values()))[-2] <= limit
    assert all(read_record(files[r["file"]], r["offset"], r["length"]) == records[r["page_id"]] for r in found)
