"""License scans, the filter audit and the manifest against SQL and brute force."""

import collections
import hashlib
import itertools
import os
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from veilmark.llm import check_sql, filter_audit, license_scan, merkle_manifest
from veilmark.llm.queries import registered

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "leaf string, pos int, key string, part string, label string, words string"
)
LONG = " ".join(f"w{i % 3000}" for i in range(30_000))
MIT = license_scan.NOTICES["mit"][1]
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \t\n", "en", "", 3),
    (4, "Licensed under the MIT License", "en", "s", 3),
    (5, "one", "en", None, 3),
    (5, "one", "en", None, 3),
    (5, "one", "en", "t", 4),
    (6, LONG, "en", "s", len(LONG)),
    (7, LONG + " mit license" * 3, "en", "s", 5),
    (14, "one", "de", "t", None),
    (None, "one", "de", "t", 3),
    (None, "one", "de", "t", 3),
    (None, None, "fr", "t", 3),
    (9, "Ünïcödé ’s \U0001f44d́ Å\n\nÅ $ A B C", "", "s", 20),
    (-3, "one", "zz", "u", 1),
    (11, f"Start {MIT} and after", "en", "s", 9),
    (12, MIT.replace("free of charge", "wholly free of charge"), "en", "s", 9),
    (13, " ".join(MIT.split()[:20]), "en", "s", 9),
    (15, f"{MIT} {MIT} general public license", "en", "s", 9),
    (16, "This work is licensed under CC-BY-NC 4.0", "en", "s", 9),
]


@pytest.fixture(scope="module")
def odd_rows():
    return [(*r, "x", 1, "k", "p", "l", "w") for r in ODD]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(check_sql.checks()))
def test_query_equals_its_check(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = registered()[name](spark, sf_dir)
    cursor = con.execute(check_sql.checks()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == expected
    assert expected


# License scan


def scan_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def licenses_by_force(text):
    words, found, best = scan_words(text), set(), 0.0
    for label, notices in license_scan.NOTICES.items():
        for notice in notices:
            wanted = scan_words(notice)
            hits = collections.defaultdict(list)
            places = collections.defaultdict(list)
            for t in range(len(wanted) - 2):
                places[tuple(wanted[t : t + 3])].append(t)
            for p in range(len(words) - 2):
                for t in places.get(tuple(words[p : p + 3]), ()):
                    hits[p - t].append((p, t))
            islands, shift = [], min(max(len(wanted) // 4, 1), 8)
            for diagonal in sorted(hits):
                if not islands or diagonal - islands[-1][0] > shift:
                    islands.append([diagonal, []])
                islands[-1][0] = diagonal
                islands[-1][1] += hits[diagonal]
            for _, pairs in islands:
                covered = {t + j for _, t in pairs for j in range(3)}
                span = max(p for p, _ in pairs) + 3 - min(p for p, _ in pairs)
                score = len(covered) / max(len(wanted), span)
                best = max(best, score)
                if score >= 0.8:
                    found.add(label)
    base, starts = set(), []
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += at
        base |= {label} if at else set()
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | found)),
        best,
    )


def test_licenses_by_force(odd, odd_rows):
    rows = license_scan.document_licenses(odd).collect()
    got = sorted(((r[0], *r[1:7], round(r[7], 9)) for r in rows), key=repr)
    expected = [(r[0], *licenses_by_force(r[1])) for r in odd_rows]
    assert got == sorted(((*e[:7], round(e[7], 9)) for e in expected), key=repr)
    labels = {r["doc_id"]: r["labels"] for r in rows}
    assert labels[11] == labels[12] == "mit" and labels[13] == ""
    assert labels[15] == "gpl,mit" and labels[16] == "cc-by-nc"


def test_license_spans_tell_places(odd):
    spans = license_scan.license_spans(odd).where("doc_id in (11, 15) and is_license")
    rows = sorted(tuple(r) for r in spans.select("doc_id", "label", "nth", "first", "last").collect())
    n = len(scan_words(MIT))
    assert rows == [(11, "mit", 1, 1, n), (15, "mit", 1, 0, n - 1), (15, "mit", 1, n, 2 * n - 1)]


def test_no_documents_no_licenses(empty):
    assert license_scan.document_licenses(empty).count() == 0


# Filter audit


def audit_by_force(rows, labels):
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    seen = []
    for doc_id, text, _, source, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > least[text],
        }
        seen.append((source or "", {f for f, failed in fails.items() if failed}, labels.get(doc_id, ())))
    out, removed_by = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {s[0] for s in seen}:
            left = [s for s in seen if s[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                here = [s for s in left if letter in s[1]]
                left = [s for s in left if letter not in s[1]]
                out[part, order, step] = [
                    len(left),
                    len(here),
                    sum(letter in s[1] for s in gone),
                    sum(s[0] == part and s[1] == {letter} for s in seen),
                    sum("good" in s[2] for s in here),
                    sum("toxic" in s[2] for s in here),
                ]
                removed_by[part, letter] += len(here)
                gone += here
    return sorted(
        (*key, *values, removed_by[key[0], key[1][key[2] - 1]]) for key, values in out.items()
    )


def audited(spark, folder, schema, labels, per_batch=1, buckets=3):
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
    docs = docs.parquet(f"{folder}/docs")
    counted = filter_audit.counters(docs, labels, f"{folder}/state", buckets)
    return filter_audit.interactions(counted)


def write_files(spark, folder, rows, per_file):
    """Files in the given order of rows, as a stream reads older files first."""
    os.makedirs(f"{folder}/docs", exist_ok=True)
    for i in range(0, len(rows), per_file):
        part = f"{folder}/part-{i}"
        spark.createDataFrame(rows[i : i + per_file], SCHEMA).coalesce(1).write.parquet(part)
        name = next(n for n in os.listdir(part) if n.endswith(".parquet"))
        target = f"{folder}/docs/{i:05}.parquet"
        os.link(f"{part}/{name}", target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(4, 1, 0), (5, 0, 1), (5, 1, 0), (14, 0, 1), (-3, 1, 1), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


FORCED = {4: ("good",), 5: ("toxic", "good"), 14: ("toxic",), -3: ("good", "toxic")}


@pytest.mark.parametrize("descending", [True, False])
def test_audit_takes_back(spark, tmp_path, odd_rows, labelled, descending):
    rows = sorted(odd_rows, key=lambda r: (r[0] is None, r[0] or 0), reverse=descending)
    write_files(spark, str(tmp_path), rows, 4)
    got = audited(spark, str(tmp_path), SCHEMA, labelled).collect()
    assert sorted(tuple(r) for r in got) == audit_by_force(odd_rows, FORCED)
    changes = spark.read.parquet(f"{tmp_path}/state/changes")
    assert changes.select("batch").distinct().count() == 5
    assert (changes.where("n < 0").count() > 0) == descending


def test_audit_goes_on_after_more_files(spark, tmp_path, odd_rows, labelled):
    """A second run with the same folder counts only what is new."""
    folder = str(tmp_path)
    write_files(spark, folder, odd_rows[8:], 4)
    audited(spark, folder, SCHEMA, labelled).count()
    write_files(spark, f"{folder}/more", odd_rows[:8], 8)
    os.link(f"{folder}/more/docs/00000.parquet", f"{folder}/docs/late.parquet")
    for _ in range(2):
        got = audited(spark, folder, SCHEMA, labelled).collect()
        assert sorted(tuple(r) for r in got) == audit_by_force(odd_rows, FORCED)


def test_audit_of_nothing(spark, tmp_path, empty, labelled):
    empty.write.parquet(f"{tmp_path}/docs")
    assert audited(spark, str(tmp_path), SCHEMA, labelled).count() == 0


def test_a_hot_text_moves_as_few_rows(spark, odd_rows, labelled):
    """A text with thousands of copies is a few rows per batch before the shuffle."""
    rows = spark.range(5000).select(
        (5000 - F.col("id")).alias("doc_id"),
        F.lit("the same text").alias("text"),
        F.lit("s").alias("source"),
    )
    slim = filter_audit.judged(rows.coalesce(1), labelled, 7)
    moved = filter_audit.map_arrow(slim, filter_audit.combined, filter_audit.KEYED).collect()
    assert len(moved) < 20 and sum(r["n"] for r in moved) == 5000
    assert sum(r["n"] for r in moved if r["key"] is not None) == 1


# Manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_by_force(nodes, k):
    """Root and, per leaf, what stands left and right of its ancestors."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + k, len(nodes))) for a in range(0, len(nodes), k)]
        for run in runs:
            for i in run:
                beside = "".join(nodes[run[0] : i]), "".join(nodes[i + 1 : run[-1] + 1])
                for leaf in members[i]:
                    paths[leaf].append(beside)
        members = [sum((members[i] for i in run), []) for run in runs]
        nodes = [sha(*nodes[run[0] : run[-1] + 1]) for run in runs]
    return nodes[0], paths


def leaf_by_force(row):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, n_chars, text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def manifest_by_force(rows, k=2):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf_by_force(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree_by_force([m[2] for m in sorted(groups[g], key=lambda m: m[:3])], k) for g in names}
    root, above = tree_by_force([trees[g][0] for g in names], k)
    out = []
    for g, upper in zip(names, above, strict=True):
        for (*_, leaf, r), path in zip(sorted(groups[g], key=lambda m: m[:3]), trees[g][1], strict=True):
            doc_id, text, lang, source, n_chars = r
            node = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None:
                node = leaf_by_force((doc_id, text, lang, source, n_chars + 1))
            for left, right in path + upper:
                node = sha(left, node, right)
            proof = sha(*["".join(step) for step in path + upper])
            out.append((doc_id, leaf, trees[g][0], root, proof, node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fan_out", [2, 3, 5])
@pytest.mark.parametrize("n", [1, 2, 17, 700])
def test_manifest_by_force(spark, n, fan_out):
    rows = [(i, f"t{i % 5}", "en" if i % 3 else f"l{i % 4}", "s", i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle_manifest.document_manifest(docs.repartition(4), fan_out).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest_by_force(rows, fan_out)


def test_manifest_of_odd_rows(odd):
    got = merkle_manifest.document_manifest(odd).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest_by_force(ODD)


def test_manifest_of_repeated_rows(spark):
    """Equal rows without an id, more than a chunk of them: each is a leaf."""
    rows = [(None, "a", None, None, None)] * 600 + [(i, "b", "x", None, 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle_manifest.document_manifest(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest_by_force(rows)
    assert all(r["verified"] for r in got if r["doc_id"] is None)


def test_manifest_of_nothing(empty):
    assert merkle_manifest.document_manifest(empty).count() == 0
