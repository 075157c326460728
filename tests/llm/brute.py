"""The operators' results once more, in plain Python over all rows and all pairs."""

import hashlib
import re
import zlib

import numpy as np
import pandas as pd


def near_duplicates(rows, words):
    """{doc_id: (n_shingles, component_id)} from all pairs."""
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(words, len(w)) or 1
        sets[doc] = {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if w else set()
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(sets, key=lambda d: len(sets[d]))
    for i, a in enumerate(docs):
        for b in docs[i + 1:]:
            if 100 * len(sets[a]) < 80 * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def exact_duplicates(rows):
    """Sorted (doc_id, keep_id, group_size, kept, text_sha256)."""
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in rows]
    df = pd.DataFrame(norm, columns=["doc_id", "norm"])
    keep = df.groupby("norm").doc_id.agg(["min", "size"])
    return sorted((d, keep.loc[t, "min"], keep.loc[t, "size"], d == keep.loc[t, "min"],
                   hashlib.sha256(t.encode()).hexdigest()) for d, t in norm)


_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
    counts = [sum(f[2] == k for f in found) for k in ("assign", "access", "hex")]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def verbatim(rows, items, window):
    """{(doc_id, item_id)} where a text has half of the item's windows of lower-case words."""
    def windows(text):
        w = re.findall(r"\w+", text.lower())
        return {tuple(w[i: i + window]) for i in range(len(w) - window + 1)}

    kept = [(i, windows(t)) for i, t in items]
    return {(d, i) for d, t in rows for i, w in kept if 2 * len(w & windows(t)) >= len(w)}


def rotated(turns, who):
    """(rendering, mask) of the ordered (turn, speaker, text) of a dialogue."""
    text, mask = "", []
    for _, speaker, said in turns:
        name = "system" if speaker == "system" else "assistant" if speaker == who else f"user name={speaker}"
        text += f"<|im_start|>{name}\n"
        begin = len(text)
        text += f"{said}<|im_end|>\n"
        mask += [(begin, len(text))] if speaker == who else []
    return text, mask


def ids_crc32(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
          ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_rule(url):
    """(host, path, rule, verdict of the rule)."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:cut])
    path = re.split("[?#]", rest[cut:], maxsplit=1)[0]
    fit = [(len(h + p), h + p, v) for v, h, p in _RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fit)[1:]) if fit else (host, path, None, None)
