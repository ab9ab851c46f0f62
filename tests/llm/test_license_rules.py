"""Each licence rule on strings made from its own expression: the keyword never hides a match."""

import re
import re._parser as parser
from itertools import product

from tallyseq.llm import license_scan


def strings(tree):
    """Some strings of an expression: each alternative, and optional parts both absent and present."""
    parts = [[""]]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(arg)])
        elif name == "ANY":
            parts.append(["x"])
        elif name == "IN":
            kind, first = arg[0]
            parts.append([chr(first) if str(kind) == "LITERAL" else chr(first[0]) if str(kind) == "RANGE" else "7" if "DIGIT" in str(first) else "w"])
        elif name == "BRANCH":
            parts.append([s for branch in arg[1] for s in strings(branch)])
        elif name == "SUBPATTERN":
            parts.append(strings(arg[3]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            some = strings(inner)
            parts.append(([""] if low == 0 else []) + [s * max(low, 1) for s in some])
        else:
            assert name.startswith("ASSERT"), name
    return ["".join(x) for x in list(product(*parts))[:64]]


def test_keywords_stand_in_all_matches():
    assert len(license_scan.RULES) > 450
    for rule in license_scan.RULES:
        assert len(rule.keyword) >= 3
        for text in strings(parser.parse(rule.pattern.pattern.decode(), re.DOTALL)):
            norm = license_scan.normalised(text)
            if rule.pattern.search(norm):
                assert rule.keyword in norm, (rule.pattern.pattern, norm)
        assert any(rule.pattern.search(license_scan.normalised(t)) for t in strings(parser.parse(rule.pattern.pattern.decode(), re.DOTALL)))


def test_text_signatures_win_over_names():
    text = "You may not use this file except in compliance with the License. You may obtain a copy of the License at the usual place, Apache License 2.0."
    found = license_scan.scan_text(text)
    assert found[5] == "apache,apache-2.0" and found[6] > 0.99
    assert license_scan.scan_text("")[5] == license_scan.scan_text(None)[5] == ""
