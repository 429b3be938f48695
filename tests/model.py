"""The build's rules as sets and minima, to check the Spark plans against.

A result is stated by what holds of it: of all figure-image pairs that the
rules allow, each id keeps the least one in (line, figure) order.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import zlib
from itertools import groupby
from pathlib import PurePosixPath

EXTS = (".jpg", ".jpeg", ".png", ".tif", ".tiff")
# Leading bytes of the image formats we accept as decodable.
SIGS = (b"\xff\xd8\xff", b"\x89PNG\r\n\x1a\n", b"II*\x00", b"MM\x00*", b"GIF8", b"BM")
# Upper ends of the splits' buckets.
SPLITS = ((97, "train"), (98, "dev"), (100, "test"))


def bucket(key: str) -> int:
    return int.from_bytes(hashlib.md5(key.encode()).digest()[:4], "big") % 100


def split_of(key: str) -> str:
    return min(s for s in SPLITS if bucket(key) < s[0])[1]


def places(names) -> dict[str, list[int]]:
    """Lower-cased base name of each image file -> its positions, ascending."""
    images = sorted((PurePosixPath(n).name.lower(), p) for p, n, is_file in names if is_file and PurePosixPath(n.lower()).name.endswith(EXTS))
    return {key: [p for _, p in group] for key, group in groupby(images, key=lambda x: x[0])}


def image_map(names) -> dict[str, int]:
    """Each image name stands for its last file; names in the order of their first one."""
    at = places(names)
    return {key: at[key][-1] for key in sorted(at, key=at.get)}


def match(imap: dict, ref: str, strict: bool = False):
    """The image of least rank: (0, candidate number) if its name is a candidate, (1, order) if it holds the stem."""
    base = PurePosixPath(ref).name
    stem = PurePosixPath(base).stem
    wanted = {name.lower(): k for k, name in reversed([*enumerate([base, *(stem + e for e in EXTS)])])}
    ranks = [(0, wanted[key]) if key in wanted else (1, order) for order, key in enumerate(imap)]
    able = [(rank, pos) for rank, (key, pos) in zip(ranks, imap.items()) if rank[0] == 0 or not strict and stem in key]
    return min(able)[1] if able else None


def png_bytes(w: int = 3, h: int = 2) -> bytes:
    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + b"\xff\x00\x00" * w for _ in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def targz(entries) -> bytes:
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        for name, data in entries:
            if data is None:  # a directory
                info = tarfile.TarInfo(name)
                info.type = tarfile.DIRTYPE
                tar.addfile(info)
                continue
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return buf.getvalue()


def article_xml(pmid, pmc, figs, extra="") -> bytes:
    """figs: list of (fig_id, label, caption_xml, href or None)."""
    parts = ['<?xml version="1.0"?>', f'<article xmlns:xlink="http://www.w3.org/1999/xlink">{extra}<front><article-meta>']
    if pmid is not None:
        parts.append(f'<article-id pub-id-type="pmid">{pmid}</article-id>')
    if pmc is not None:
        parts.append(f'<article-id pub-id-type="pmc">{pmc}</article-id>')
    parts.append("</article-meta></front><body>")
    for fid, label, cap, href in figs:
        g = f'<graphic xlink:href="{href}"/>' if href is not None else ""
        parts.append(f'<fig id="{fid}"><label>{label}</label><caption>{cap}</caption>{g}</fig>')
    parts.append("</body></article>")
    return "".join(parts).encode("utf-8")


def contents(package) -> list[tuple[str, bool, bytes]] | None:
    """(name, is a file, bytes) of each member in order; None for what is no archive."""
    try:
        with tarfile.open(fileobj=io.BytesIO(package or b""), mode="r:gz") as tar:
            return [(m.name, m.isfile(), tar.extractfile(m).read() if m.isfile() else b"") for m in tar]
    except (tarfile.ReadError, EOFError, OSError, zlib.error):
        return None


def allowed(entry: dict, package, parse) -> list[dict]:
    """All pairs of one catalogue line that the rules allow, with their place in the article."""
    members = contents(package) or []
    articles = [data for name, _, data in members if name.lower().endswith(".nxml")]
    figures = parse(articles[0])[0] if articles else []
    imap = image_map([(k, name, is_file) for k, (name, is_file, _) in enumerate(members)])
    ids = {"pmid": entry["pmid"], "pmc": entry["pmcid"], **{k: v for k, v in (figures[0] if figures else {}).items() if k in ("pmid", "pmc") and v}}
    hits = [(k, f, (f["fig_caption"] or "").strip(), match(imap, f["graphic_ref"]) if f["graphic_ref"] else None) for k, f in enumerate(figures)]
    return [{"place": (entry["line_no"], k), "image": f"{ids['pmc']}/{ids['pmc']}_fig-{f['fig_id'] or ''}.jpg", "caption": caption, "pmid": ids["pmid"],
             "pmcid": ids["pmc"], "pair_id": f"{ids['pmid']}_{f['fig_id'] or ''}", "split": entry["split"]}
            for k, f, caption, at in hits if caption and at is not None and members[at][2].startswith(SIGS)]


def build_model(entries, packages, parse, existing=(), resume=True):
    """entries: dicts (line_no, pmcid, pmid, split); packages: pmcid -> tar.gz bytes; parse: bytes -> (figures, error)."""
    every = sorted((p for e in entries for p in allowed(e, packages.get(e["pmcid"]), parse)), key=lambda p: p["place"])
    least = {(p["split"], p["pair_id"]): p["place"] for p in reversed(every)}
    chosen = [p for p in every if not resume or (least[p["split"], p["pair_id"]] == p["place"] and (p["split"], p["pair_id"]) not in set(existing))]
    return [{k: v for k, v in p.items() if k != "place"} for p in chosen]
