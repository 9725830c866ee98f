import re

from vigil.llm import license_scan
from vigil.sources.tables import table

SF001 = "/root/testdata/sf0.01"


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def scanned(spark, texts):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, low string, words string")
    return {r.id: r for r in license_scan.scan(df).collect()}


def test_base_places_match_brute_force(spark):
    docs = table(spark, SF001, "documents")
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    got = {r.id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan.scan(docs).collect()}
    assert got == want and any(v[1] for v in want.values())


def test_edge_cases(spark):
    texts = [None, "", "   ", "MIT License", "the mit\n-- LICENSE; apache license apache license", "mit licenses", "KMIT license",
             "GNU General Public License", "x " * 30000 + "mit license"]
    got = scanned(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t)
    assert (got[0].labels, got[0].score) == ("", 0.0)


def test_rules_label_and_suppress(spark):
    assert len(license_scan.rules()) > 200
    got = scanned(spark, ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
                          "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
                          "SPDX-License-Identifier: MIT", "All rights reserved.", "the license of the plate"])
    labels = [got[i].labels for i in range(7)]
    assert labels == ["apache,apache-2.0", "mit", "gpl,gpl-3.0", "cc-by-nc", "mit", "all-rights-reserved", ""]
    for r in got.values():  # of what stays, nothing overlaps
        assert all(a["end"] <= b["start"] for a, b in zip(r.detections, r.detections[1:]))


def samples(regex):
    """Texts that ``regex`` matches: each choice once, with none and one of what is optional."""
    def one(op, arg):
        name = str(op)
        if name == "LITERAL":
            return [chr(arg)]
        if name == "IN":
            kinds = [(str(o), a) for o, a in arg]
            if ("CATEGORY", "CATEGORY_SPACE") in [(o, str(a)) for o, a in kinds]:
                return [" ", "\n", "\t"]
            return [chr(a if o == "LITERAL" else a[0]) for o, a in kinds]
        if name == "BRANCH":
            return [t for some in arg[1] for t in every(some)]
        if name == "SUBPATTERN":
            return every(arg[3])
        if name == "MAX_REPEAT":
            low, high, some = arg
            texts = every(some)
            return ([""] if low == 0 else []) + [t * max(low, 1) for t in texts] + ([t * 2 for t in texts] if high > 2 else [])
        assert name == "AT", name
        return [""]

    def every(parsed):
        out = [""]
        for op, arg in parsed:
            more = one(op, arg)
            # all choices where these are few, else each choice beside the first of the others
            out = [a + b for a in out for b in more] if len(out) * len(more) <= 400 else [a + more[0] for a in out] + [out[0] + b for b in more[1:]]
        return out

    return every(re._parser.parse(regex))


def test_gates_let_through_what_the_rules_match():
    gates = {order: gate for gate, some in license_scan._prefilter() for order, *_ in some}
    for order, (label, _, _, regex) in enumerate(license_scan.rules()):
        texts = [t for t in samples(regex) if re.search(regex, t)]
        assert texts, regex
        for t in texts:
            assert re.search(gates[order], t) and re.search(license_scan.ANCHOR, t), (label, t)


def test_other_spellings_are_found(spark):
    got = scanned(spark, ["Licensed under the Expat License.", "SPDX-License-Identifier: Expat", "dedicated to the public\ndomain", "placed into the public \t domain",
                          "License: public  domain", "a public\ndomain of many"])
    assert [got[i].labels for i in range(6)] == ["mit", "mit", "public-domain", "public-domain", "public-domain", ""]
    assert got[0].score == 0.95 and got[2].score == 0.6


def test_empty_table(spark):
    assert scanned(spark, []) == {}


def test_no_python_in_the_plan(spark):
    plan = license_scan.scan(table(spark, SF001, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)


def test_many_hits_in_one_text(spark, monkeypatch):
    n = 700  # several runs of hits, with and without a rest
    text = "Licensed under the MIT License. " * n
    for run in (1, 128, 350, 10_000):
        monkeypatch.setattr(license_scan, "RUN", run)
        r = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        assert len(r.detections) == n and r.n_base == n and r.labels == "mit"
        ends = [(d.start, d.end) for d in r.detections]
        assert all(b[0] - a[0] == 32 for a, b in zip(ends, ends[1:])) and all(text.lower()[a:b].startswith("licensed under") for a, b in ends)


def test_license_texts_and_identifiers(spark):
    said = {
        "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software": "mit",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered": "bsl-1.0",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above": "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.": "0bsd",
        "Redistribution and use in source and binary forms, with or without\n  modification, are permitted. Neither the name of X nor the names of its contributors may be used to endorse": "bsd,bsd-3-clause",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of": "gpl,gpl-3.0",
        "It is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, or not": "gpl,lgpl",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file": "apache,apache-2.0",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "see GPL-3.0-or-later, or BSD-3-Clause": "bsd-3-clause,gpl-3.0", "AGPL-3.0-only": "agpl-3.0", "pkg (Apache-2.0)": "apache-2.0", "CC-BY-NC-SA-4.0": "cc-by-nc-sa",
        "we grant permission to use the redistribution center and its contributors": "", "a gpl-like thing, bsd-ish, mpl-7": "",
    }
    got = scanned(spark, list(said))
    assert {t: got[i].labels for i, t in enumerate(said)} == said
    assert all(a["end"] <= b["start"] for r in got.values() for a, b in zip(r.detections, r.detections[1:]))


def test_labels_and_score_match_brute_force_rules(spark):
    """All rules without any gate, places by Python's regexes, suppression by its definition."""
    texts = ["Licensed under the MIT License. Licensed under the Apache License, Version 2.0; subject to the GNU GPL v3 license",
             "SPDX-License-Identifier: GPL-2.0-or-later; License: BSD-2-Clause license, released under the CC BY-SA 4.0", "ISC license MIT license, version 2 zlib/libpng license",
             "distributed under the terms of the Mozilla Public License 2.0 license and all rights reserved GPL-3.0", "nothing here", "the public domain license: unlicense"]
    got = scanned(spark, texts)
    for i, t in enumerate(texts):
        low = t.lower()
        found = sorted((m.start(), -m.end(), order, label, conf) for order, (label, _, conf, rx) in enumerate(license_scan.rules()) for m in re.finditer(rx, low))
        kept = []
        for d in found:  # in order of place: within the last one, or overlapping it as a later rule, is suppressed
            if kept and d[0] < -kept[-1][1]:
                if -d[1] > -kept[-1][1] and d[2] < kept[-1][2]:
                    kept[-1] = d
            else:
                kept.append(d)
        base = set(filter(None, brute(t)[4].split(",")))
        assert got[i].labels == ",".join(sorted(base | {d[3] for d in kept})), t
        assert got[i].score == max([d[4] for d in kept] + ([license_scan.BASE_SCORE] if base else [0.0])), t
