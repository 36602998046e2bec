"""Small file fixtures written into a scratch folder (stdlib only)."""

import io
import json
import os
import struct
import tarfile
import zlib


def png_bytes(width, height, pixel, grey=False):
    """A valid PNG: RGB (colour type 2) or grey (colour type 0), 8 bits."""
    ch = 1 if grey else 3
    raw = b"".join(b"\x00" + bytes(pixel(x, y) for x in range(width) for _ in [0]) if grey else
                   b"\x00" + b"".join(bytes(pixel(x, y)) for x in range(width)) for y in range(height))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", width, height, 8, 0 if grey else 2, 0, 0, 0)
    assert ch in (1, 3)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def image_tree(root):
    """root/{train,test}/<label>/<Label>_<n>.png, one grey and one corrupt file."""
    files = []
    for split in ("train", "test"):
        for label in ("Persian", "Ragdoll"):
            d = os.path.join(root, split, label)
            os.makedirs(d, exist_ok=True)
            for n in range(3):
                shade = 40 if label == "Persian" else 200
                data = png_bytes(6 + n, 5, lambda x, y, s=shade, n=n: (s, (x * 20 + n) % 256, y * 30))
                p = os.path.join(d, f"{label}_{n}_{split}.png")
                with open(p, "wb") as f:
                    f.write(data)
                files.append(p)
    grey = os.path.join(root, "train", "Persian", "Persian_9_grey.png")
    with open(grey, "wb") as f:
        f.write(png_bytes(4, 4, lambda x, y: x * 40 + y, grey=True))
    bad = os.path.join(root, "test", "Ragdoll", "Ragdoll_9_bad.png")
    with open(bad, "wb") as f:
        f.write(b"\x89PNG not really")
    return files + [grey, bad]


def archive(path, names):
    """A tar.gz whose first member is the root folder, then root/<name> files."""
    with tarfile.open(path, "w:gz") as tf:
        info = tarfile.TarInfo("images")
        info.type = tarfile.DIRTYPE
        tf.addfile(info)
        for n in names:
            data = n.encode()
            ti = tarfile.TarInfo(f"images/{n}")
            ti.size = len(data)
            tf.addfile(ti, io.BytesIO(data))


def feature_files(root, rows):
    """root/<split>/<label>/<stem>.json with a bare array, null, or junk."""
    for split, label, name, payload in rows:
        d = os.path.join(root, split, label)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, name), "w") as f:
            f.write(payload if isinstance(payload, str) else json.dumps(payload))
