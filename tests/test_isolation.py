"""The training-data package is optional: nothing else imports it."""

import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_nothing_else_imports_it():
    for folder, _, names in os.walk(os.path.join(ROOT, "surveypulse")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert not re.search(r"surveypulse\.llm|corpus_pipeline", f.read()), name
