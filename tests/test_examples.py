"""The Python blocks of docs/EXAMPLES.md run in order."""

import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_examples_run(spark):
    text = open(os.path.join(ROOT, "docs", "EXAMPLES.md")).read()
    blocks = re.findall(r"```python\n(.*?)```", text, re.S)
    assert len(blocks) >= 6
    scope: dict = {}
    for block in blocks:
        exec(compile(block, "EXAMPLES.md", "exec"), scope)  # noqa: S102
