"""Builders shared by the tests."""

import json
import random

MESSAGES = "array<struct<role:string,content:string>>"
RECORD = f"line_no long, id string, messages {MESSAGES}, category string, source string, language string, script string, code_switching boolean, difficulty string, quality struct<reviewed:boolean,native_authored:boolean,synthetic:boolean,flagged:boolean>, split string"


def good(**over):
    r = {"id": "a-1", "messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}], "category": "coding", "source": "s", "language": "en"}
    return {k: v for k, v in (r | over).items() if v != "__drop__"}


def record(n, user="hi", assistant="yo", **over):
    r = {"line_no": n, "id": f"r-{n:05d}", "messages": [("user", user), ("assistant", assistant)], "category": "coding", "source": "s", "language": "en", "script": None, "code_switching": None, "difficulty": None, "quality": None, "split": "train"} | over
    return tuple(r[k] for k in ("line_no", "id", "messages", "category", "source", "language", "script", "code_switching", "difficulty", "quality", "split"))


def write_lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    return str(path)


def words(rng: random.Random, n: int, vocabulary: int = 500) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
