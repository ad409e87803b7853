"""Merkle manifest, filter audit and license scan, against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from quire.llm import filter_audit, license_scan, merkle_manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves, as columns of the input that don't matter.
CLASHING = {c: "clash" for c in ("tree", "leaf", "fake", "nr", "n", "h", "part", "mask", "same", "words", "th", "at", "label", "score", "block", "_row", "_part")}


def frame(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(v) for c, v in CLASHING.items()})


def got(df):
    return sorted((tuple(sorted(r.asDict().items(), key=str)) for r in df.collect()), key=str)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)])


def low(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def climbed(nodes):
    """Levels of a tree, leaves first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, at):
    """Left and right of each ancestor in its run."""
    for nodes in levels[:-1]:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        yield run[: at % 8], run[at % 8 + 1 :]
        at //= 8


def manifest_by_hand(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {x: climbed([t[2] for t in sorted(trees[x], key=lambda t: t[:3])]) for x in names}
    top = climbed([levels[x][-1][0] for x in names])
    out = []
    for x in names:
        for i, (_, _, own, r) in enumerate(sorted(trees[x], key=lambda t: t[:3])):
            struck = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            cur, proof = leaf(r, low(r[1])) if struck else own, ""
            for left, right in [*siblings(levels[x], i), *siblings(top, names.index(x))]:
                proof += "".join(left + right)
                cur = h(*left, cur, *right)
            out.append({"doc_id": r[0], "leaf": own, "subroot": levels[x][-1][0], "root": top[-1][0], "proof_sha256": h(proof), "folded_root": cur, "verified": cur == top[-1][0]})
    return sorted((tuple(sorted(r.items(), key=str)) for r in out), key=str)


def made_rows():
    rng = random.Random(5)
    rows = [(i, rng.choice(["Some Text ", "lower ", "É ü ½ "]) * rng.randint(0, 3), rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["a", None]), rng.choice([None, 7])) for i in range(230)]
    rows += [(5, "Again", "en", "a", 1), (5, "Again", "en", "a", 1), (None, "Of None", "en", "b", 2), (None, None, None, None, None), (9, "X" * 100_000, "fr", "c", 3)]
    return rows


@pytest.mark.parametrize("deep", [1, 2, 4])
def test_manifest(spark, monkeypatch, deep):
    monkeypatch.setattr(merkle_manifest, "DEEP", deep)
    rows = made_rows()
    found = got(merkle_manifest.manifest(frame(spark, rows)))
    assert found == manifest_by_hand(rows)
    verified = [dict(r)["verified"] for r in found]
    assert 0 < sum(verified) < len(verified)


def test_manifest_of_little(spark):
    assert merkle_manifest.manifest(frame(spark, [])).collect() == []
    for rows in ([(1, "One", "en", "a", 3)], [(1, "One", "en", "a", 3), (2, None, None, "a", 3)], [(i, "x", str(i), "a", 3) for i in range(20)]):
        assert got(merkle_manifest.manifest(frame(spark, rows))) == manifest_by_hand(rows)


def audit_by_hand(rows, labels):
    def words(text):
        return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]

    def fails(r):
        text, ws = r[1] or "", words(r[1] or "")
        smaller = r[0] is not None and any(q[0] is not None and q[0] < r[0] and (q[1] or "") == text for q in rows)
        caps = sum("A" <= c <= "Z" for c in text)
        tests = (len(ws) < 100, 100 * len(set(ws)) < 80 * len(ws), 100 * caps > 10 * len(text), any(c in "#$%&*|" for c in text), smaller)
        return "".join(f for f, t in zip("ABCDE", tests, strict=True) if t)

    best = {}
    for i, q, t in labels:
        if i is not None:
            best[i] = (max(q, best.get(i, (0, 0))[0]), max(t, best.get(i, (0, 0))[1]))
    parts = defaultdict(list)
    for r in rows:
        parts[r[2] or ""].append((fails(r), *best.get(r[0], (0, 0))))
    out = []
    for part, docs in parts.items():
        sums = Counter()
        mine = []
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                sums[f] += len(gone)
                mine.append({"part": part, "filter_order": order, "step": step, "kept": len(left), "removed": len(gone), "redundant": sum(f in d[0] for d in docs) - len(gone), "unique_fails": sum(d[0] == f for d in docs), "good_lost": sum(d[1] == 1 for d in gone), "toxic_lost": sum(d[2] == 1 for d in gone)})
        out += [r | {"shapley": sums[r["filter_order"][r["step"] - 1]]} for r in mine]
    return sorted((tuple(sorted(r.items(), key=str)) for r in out), key=str)


def test_audit(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["word", "Other", "more", "x$", "YELL", f"w{i}"]) + str(rng.randint(0, k)) for i in range(n)) for n, k in [(120, 200), (120, 1), (20, 50), (150, 500), (99, 900), (100, 900)] for _ in range(4)]
    rows = [(i, rng.choice([*texts, None, "", " "]), rng.choice(["en", "en", "de", None, ""]), "a", 1) for i in range(150)]
    rows += [(3, rows[3][1], "en", "a", 1), (3, rows[3][1], "en", "a", 1), (3, texts[0], "fr", "a", 1), (-4, texts[1], "de", "a", 1), (None, texts[2], "en", "a", 1), (None, texts[2], "en", "a", 1), (500, " ".join(f"k{i}" for i in range(30_000)), "en", "a", 1)]
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    found = filter_audit.audit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got(found) == audit_by_hand(rows, labels)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(frame(spark, []), none).collect() == []
    assert got(filter_audit.audit(frame(spark, [(1, None, None, None, None)]), none)) == audit_by_hand([(1, None, None, None, None)], [])


def scan_by_hand(rows, templates, threshold):
    ready = license_scan.prepared(templates, threshold)
    out = []
    for r in rows:
        ws = [w for w in __import__("re").split(license_scan.NO_WORD, low(r[1] or "")) if w]
        places = [(i, label) for phrase, label in license_scan.PHRASES for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
        met = {}
        for t in ready:
            for at in range(0, len(ws), t.half):
                c = len(set(t.tokens) & set(ws[at : at + 2 * t.half])) / len(t.tokens)
                if c * len(t.tokens) >= t.need:
                    met[t.label] = max(met.get(t.label, 0), c)
        base = {label for _, label in places}
        starts = [i for i, _ in places]
        out.append({"doc_id": r[0], "n_words": len(ws), "n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None), "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | set(met))), "score": 1.0 if places else max(met.values(), default=0.0)})
    return sorted((tuple(sorted(x.items(), key=str)) for x in out), key=str)


def license_rows():
    rng = random.Random(11)
    fill = ["the", "of", "license", "public", "work", "under", "software", "x1", "étude", "b", "general", "rights"]

    def noise(n):
        return [rng.choice(fill) for _ in range(n)]

    rows = []
    for i in range(160):
        words = noise(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            notice = rng.choice(license_scan.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 3)):  # words lost or changed
                notice[rng.randrange(len(notice))] = rng.choice(fill)
            words += notice + noise(rng.randint(0, 90))
        rows.append((i, rng.choice([" ", "\n", " -- "]).join(words), "en", "a", 1))
    rows += [(200, None, None, None, None), (201, "", "en", "a", 1), (202, "CC\nBY, cc-by CC by. All rights\treserved; General Public License", "en", "a", 1), (7, "other text under the MIT license released", "en", "a", 1), (7, rows[7][1], "en", "a", 1), (None, rows[8][1], "en", "a", 1)]
    return rows + [(203, " ".join(noise(30_000)) + " Released under the MIT License. " + " ".join(noise(9000)), "en", "a", 1)]


@pytest.mark.parametrize("threshold", [0.9, 0.6])
def test_licenses(spark, threshold):
    rows = license_rows()
    found = got(license_scan.scan(frame(spark, rows), threshold=threshold))
    assert found == scan_by_hand(rows, license_scan.TEMPLATES, threshold)
    assert sum(dict(r)["labels"] != dict(r)["base_labels"] for r in found) > 30


def test_licenses_of_nothing(spark):
    assert license_scan.scan(frame(spark, [])).collect() == []
    rows = [(1, "cc by", "en", "a", 1), (2, "x", "en", "a", 1)]
    assert got(license_scan.scan(frame(spark, rows), templates=[("no", " ..")])) == scan_by_hand(rows, [], 0.9)
    with pytest.raises(ValueError):
        license_scan.prepared([("long", " ".join(f"w{i}" for i in range(license_scan.MOST_WORDS + 1)))], 0.9)
