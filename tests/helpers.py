"""A plain-Python curation, written apart from the columns, and record makers."""

from __future__ import annotations

import uuid

KEEP = {"noun", "verb", "adj", "adv", "pron", "num", "prep", "phrase", "intj", "det"}
FLAGS = {"proverb": "entry_type:proverb", "suffix": "entry_type:affix", "prefix": "entry_type:affix", "name": "entry_type:proper_name"}
RAW_DDL = "id long, run_id string, snapshot_id string, source_line long, word string, lang string, lang_code string, pos string, payload string"


def t(x):
    return x.strip() or None if isinstance(x, str) else None


def texts(x):
    return list(dict.fromkeys(v for v in map(t, x if isinstance(x, list) else []) if v))


def first(x):
    return next((v for v in map(t, x if isinstance(x, list) else [x]) if v), None)


def rels(items, kind, scope):
    out = []
    for x in items if isinstance(items, list) else []:
        w, lc = (t(x.get("word")), t(x.get("lang_code"))) if isinstance(x, dict) else (t(x), None)
        if w:
            out.append((kind, w, lc, scope))
    return out


def capped(items, cap=24):
    seen, out = {}, []
    for x in items:
        seen[x[0]] = seen.get(x[0], 0) + 1
        if seen[x[0]] <= cap:
            out.append(x)
    return out


def unique(items, key=lambda x: x):
    out = {}
    for x in items:
        out.setdefault(key(x), x)
    return list(out.values())


def sense(s):
    related = capped(unique(rels(s.get("form_of"), "form_of", "sense") + rels(s.get("alt_of"), "alternative_of", "sense") + rels(s.get("compound_of"), "compound_of", "sense")))
    return (first(s.get("glosses")) or first(s.get("raw_glosses")), tuple(texts(s.get("tags"))), t(s.get("qualifier")), tuple(related))


def curated(rows):
    """{(lang_code, normalized_word): summary} of raw rows (dicts with payload a dict)."""
    groups = {}
    for r in sorted(rows, key=lambda r: r["id"]):
        p = r["payload"]
        pos = (t(p.get("pos")) or "").casefold()
        objects = [s for s in p.get("senses") or [] if isinstance(s, dict)]
        related = [{k for k, *_ in sense(s)[3]} & {"form_of", "alternative_of"} for s in objects]
        if not t(p.get("word")) or not t(p.get("lang_code")):
            continue
        if objects and all(related) and all(sense(s)[0] is None or "plural of" in sense(s)[0].lower() for s in objects):
            continue
        if pos in KEEP or pos in FLAGS:
            groups.setdefault((r["lang_code"], (r["word"] or p.get("word") or "").lower()), []).append(r)
    out = {}
    for (lang, word), own in groups.items():
        ety, by = {}, {}
        for r in own:
            p = r["payload"]
            e = ety.setdefault(t(p.get("etymology_text")), f"et{len(ety) + 1}")
            pos = (t(r["pos"]) or "").casefold()
            g = by.setdefault((pos, e), {"senses": [], "forms": [], "rels": [], "flags": set()})
            g["flags"] |= {FLAGS[pos]} if pos in FLAGS else set()
            g["senses"] += [x for x in map(sense, [s for s in p.get("senses") or [] if isinstance(s, dict)]) if x[0]]
            forms = unique([(t(f.get("form")), tuple(texts(f.get("tags"))), t(f.get("roman"))) for f in p.get("forms") or [] if isinstance(f, dict) and t(f.get("form"))])
            g["flags"] |= {"trimmed_form_set"} if len(forms) > 48 else set()
            g["forms"] += forms[:48]
            top = sum((rels(p.get(f), k, "entry") for f, k in (("derived", "derived_term"), ("related", "related_term"), ("synonyms", "synonym"), ("antonyms", "antonym"))), [])
            g["rels"] += capped(top)
        out[lang, word] = {
            "entry_id": str(uuid.uuid5(uuid.NAMESPACE_URL, f"{lang}|{word}")),
            "ids": [r["id"] for r in own],
            "etymologies": sorted((i, x) for x, i in ety.items()),
            "groups": [(k, sorted(g["flags"]), [s[:3] for s in unique(g["senses"], lambda s: s[:3])], unique(g["forms"]), capped(unique(g["rels"]))) for k, g in sorted(by.items())],
        }
    return out
