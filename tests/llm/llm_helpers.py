import hashlib

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
