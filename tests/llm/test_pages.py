"""Operators 4, 7 and 10."""

import hashlib
import io
import json
import struct

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from conftest import SF001
from sliceflow.llm import chat, queries, url_graph, warc
from sliceflow.llm.common import filesystem, shared_folder

# ------------------------------------------------------------------ urls


def _link(host):
    return f'<a class=x HREF="https://{host}/p?q">t</a>'


PAGES = [(1, "http://A.Example.COM/de/x?q#f", None, "h"), (2, "https://sub.example.net/en/1", "", "h"), (3, "http://x.net/en/", _link("bad.net"), "h"), (4, "http://x.net", "", "h"),
         (5, None, _link("bad.net"), "h"), (6, "no scheme", "", "h"), (7, "http://org/fr/", "", "h"), (8, "http://forg/fr/", "", "h"),
         (9, "ftp://friend.of/a", _link("bad.net") * 3, "h"), (10, "http://far.of/", _link("friend.of") + _link("good.of"), "h"), (11, "http://good.of/", "<a href='/x'>", "h"),
         (12, "http://bad.net/", "<p>", "h"), (13, "http://bad.net/y", "<p>", "h"), (13, "http://bad.net/y", "<p>", "h"), (14, "://e.com?x", "", "h"), (15, "x://y://z/", "", "h"),
         (None, "http://l.of/", "x" * 200_000 + "<a href=//friend.of>", "h"), (16, "http://x.EXAMPLE.net/en/z", _link("l.of"), "h")]


def _judge():
    """(host, path, rule, verdict) of each page, from the definition."""
    out, rows = [], []
    for _, url, html, _ in PAGES:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host, rest = rest[:n], rest[n:]
            path = rest.split("?")[0].split("#")[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(t), t, k) for k, t in url_graph.RULES if (host == t.split("/", 1)[0] or host.endswith("." + t.split("/", 1)[0])) and path.startswith("/" + t.split("/", 1)[1])]
        rows.append((host, path, *(max(fits)[1:] if fits else (None, None)), html))
    edges, trust, distrust = {}, {}, {}
    for h in {r[0] for r in rows} - {""}:
        own = [r[3] for r in rows if r[0] == h]
        trust[h], distrust[h] = own.count("allow") / len(own), own.count("block") / len(own)
        seen = [t for r in rows if r[0] == h and r[4] for t in ("bad.net", "friend.of", "good.of", "l.of") for _ in range(r[4].count(f"//{t}")) if t != h]
        edges |= {(h, t): seen.count(t) / len(seen) for t in seen}
    t, d = dict(trust), dict(distrust)
    for _ in range(url_graph.ROUNDS):
        t, d = ({h: trust[h] + 0.85 * sum(w * t[a] for (a, b), w in edges.items() if b == h) for h in trust},
                {h: distrust[h] + 0.85 * sum(w * d[b] for (a, b), w in edges.items() if a == h) for h in trust})
    for host, path, rule, verdict, _ in rows:
        out.append((host, path, rule, verdict or ("block" if host and d[host] >= 0.5 and d[host] > t[host] else "allow")))
    return out


def test_urls_are_judged_as_defined(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, host string")
    got = url_graph.judge(df).collect()
    want = [(p[0], *r) for p, r in zip(PAGES, _judge())]
    assert sorted(map(str, ((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got))) == sorted(map(str, want))
    assert {r[4] for r in want if r[1] == "friend.of"} == {"block"} and {r[4] for r in want if r[1] == "good.of"} == {"allow"}
    con = duckdb.connect()
    pages = df.toPandas().astype({"page_id": "Int64"})
    con.register("pages", pages)
    assert sorted(map(str, con.execute(url_graph.ORACLE).fetchall())) == sorted(map(str, want))
    assert url_graph.judge(df.where("false")).count() == 0


def test_rounds_go_on_until_nothing_moves(spark):
    # after ten rounds b has 0.464
    seeds = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.0, 0.15)], "host string, trust double, distrust double")
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "src string, dst string, weight double")
    rank = url_graph.propagate(seeds, edges, tolerance=1e-3)
    got = {r["host"]: r["distrust"] for r in rank.collect()}
    assert abs(got["b"] - 0.15 / (1 - 0.85 ** 2)) < 3e-3 and got["b"] > url_graph.THRESHOLD and rank.rounds > url_graph.ROUNDS


def test_urls_run_without_python(spark):
    plan = url_graph.judge(spark.createDataFrame(PAGES, "page_id long, url string, html string, host string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ oracles


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF001).toPandas(), con.execute(queries.ORACLE[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda t: sorted(map(str, t[cols].itertuples(index=False, name=None)))
    assert key(got.astype(object).where(got.notna(), None)) == key(want.astype(object).where(want.notna(), None))


# ------------------------------------------------------------------ chat

_texts = st.lists(st.sampled_from(list("ab\\<|>[]/ \n") + list(chat.CONTROL)), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(_texts, _texts)
def test_turns_read_back(role, text):
    segment, start, stop, _ = chat.format_message(role, [text])
    assert chat.parse_segment(segment) == (role, text)
    body = chat.escape(text)
    assert not any(c in body for c in chat.CONTROL) and chat.unescape(body) == text
    assert start == stop or chat.unescape(segment[start:stop]) == text


def test_parts_become_placeholders():
    parts = [{"type": "text", "text": "see <|image|>"}, {"type": "image", "ref": "i1", "width": 57, "height": 28}, "and", {"type": "audio", "ref": "a", "seconds": 1.5},
             {"type": "document", "ref": "d", "pages": 3}]
    segment, start, stop, found = chat.format_message("assistant", parts)
    assert segment[start:stop] == "see <\\|image|><|image|>and<|audio|><|document|>"
    assert [(k, r, n) for k, r, _, n in found] == [("image", "i1", 3), ("audio", "a", 38), ("document", "d", 768)]
    assert all(segment[p:].startswith(chat.PLACEHOLDERS[k]) for k, _, p, _ in found)
    with pytest.raises(ValueError):
        chat.format_message("user", [{"type": "video"}])


def test_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 1, "assistant", said, 9), (1, 0, "user", "q\\", 9), (2, 0, "assistant", None, 9), (2, 0, None, "tie", 9), (2, None, "user", "first", 9), (3, 5, "assistant", "a" * 300_000, 9),
            (None, 1, "user", "x", 9), (3, 5, "assistant", "a" * 300_000, 9), (4, 0, "assistant", "", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment long")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_messages(df)).collect()}
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    for r in con.execute(chat.ORACLE).fetchall():
        if r[0] != -1 and r[0] != 2:  # of equal turns the segment decides, not role and text
            assert tuple(got[r[0]]) == r
    order = [("user", "first"), *sorted([("assistant", ""), ("", "tie")], key=lambda x: chat.format_message(x[0], [x[1]])[0])]
    assert got[2]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in order).encode()).hexdigest()
    assert got[3]["loss_chars"] == 600_000 and got[3]["n_turns"] == 2
    assert chat.format_messages(df.where("false")).count() == 0
    typed = spark.createDataFrame([(1, 0, "user", json.dumps([{"type": "image", "ref": "r"}, {"type": "text", "text": "t"}]))], "conv_id long, turn long, role string, text string")
    assert chat.format_messages(typed, parts=True).first()["attachments"][0]["ref"] == "r"


# ------------------------------------------------------------------ WARC


def test_archives(spark):
    body = "<p>équal</p>" * 20
    rows = [(5, "http://a/é %\r\n", body, "d"), (2, None, body, "d"), (9, "http://b", body, "d"), (2, None, body, "d"), (7, "u", None, "d"), (8, "u", "", "d"), (3, "u", "short", "d"),
            (4, "u", "short", "d"), (None, "u", body, "d"), (11, "u", "y" * 3_000_000, "d"), (None, "u", "z" * 100, "d"), (12, "u", "w" * 99, "d"), (13, "u", "w" * 99, "d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    files = warc.write_archives(df, shared_folder(spark, "warc"))
    got = warc.read_archives(files, payloads=True).collect()
    want = []
    for i, u, h, _ in rows:
        data = (h or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        first = min(same) if same and len(data) >= 100 else i
        again = first != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None, u, None if again else data))
    key = lambda r: str(r[:6])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert warc.write_archives(df.where("false"), shared_folder(spark, "warc")).count() == 0
    fs, path = filesystem(files.orderBy("n_records").collect()[-1]["uri"])
    data = fs.open_input_stream(path).read()
    n = struct.unpack("<I", data[4:8])[0]
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_FRAME
    assert len(list(warc.read_records(io.BytesIO(data)))) == data.count(b"\x28\xb5\x2f\xfd", 8 + n)
    for broken in (data[: 8 + n - 1] if n else data[:4], data[:-3], data[8 + n:]):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(broken)))


def test_records_are_validated():
    good = warc.record(1, "u", "response", hashlib.sha256(b"x" * 120).hexdigest(), 120, None, b"x" * 120)
    assert warc.page_row(*warc.parse_record(good))[:4] == (1, 120, hashlib.sha256(b"x" * 120).hexdigest(), "response")
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"HTTP/1.1"), good.replace(b"WARC-Date", b"Date"), good.replace(b"xx", b"x", 1), good[:30]):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)
    for old, new in ((b"sha256:", b"sha256:0"), (b"Payload-Length: 120", b"Payload-Length: 121"), (b"WARC-Type: response", b"WARC-Type: resource")):
        with pytest.raises(warc.WarcError):
            warc.page_row(*warc.parse_record(good.replace(old, new)))


@pytest.mark.parametrize("content,text,tokens", [
    ('[{"type": "text"', '[{"type": "text"', []), ('["a", 5, [1], null, {"type": "video", "x": 1}]', 'a5[1]{"type": "video", "x": 1}', []),
    ('[{"type": "image", "width": null, "height": 56}]', "<|image|>", [2]), ('[{"type": "audio", "seconds": "long"}, {"type": "audio", "seconds": 2}]', "<|audio|><|audio|>", [0, 50]),
    ('[{"type": "document", "pages": -3}, {"type": "image", "width": 1e300}, {"type": "audio", "seconds": NaN}]', "<|document|><|image|><|audio|>", [256, 1, 0]),
    ('[{"type": "text", "text": 7}, {"type": ["text"]}]', '7{"type": ["text"]}', []), ('"\\ud800x"', "?x", []), ("[" * 100_000, "[" * 100_000, []), (None, "", []), ("<|turn|>", "<|turn|>", [])])
def test_bad_parts_have_a_defined_result(spark, content, text, tokens):
    row = chat.format_messages(spark.createDataFrame([(1, 0, "user", content)], "conv_id long, turn long, role string, text string"), parts=True).first()
    assert chat.parse_segment(row["segment"]) == ("user", text)
    assert [a["tokens"] for a in row["attachments"]] == tokens
