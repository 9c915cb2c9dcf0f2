import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def sha(data):
    return hashlib.sha256(data).hexdigest()
