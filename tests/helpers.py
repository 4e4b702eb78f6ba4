"""What test modules share besides the fixtures."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"


def write_text(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def record(user="bob", message="hi", url="http://twitter.com/", t="2009-06-01 00:00:00"):
    return f"T\t{t}\nU\t{url}{user}\nW\t{message}"
