"""Zip the ``tessera`` package for ``spark-submit --py-files``.

usage: python scripts/package.py [out.zip]   (default: dist/tessera.zip)
"""
import os
import sys
import zipfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main():
    out = sys.argv[1] if len(sys.argv) > 1 else os.path.join(ROOT, "dist", "tessera.zip")
    os.makedirs(os.path.dirname(out) or ".", exist_ok=True)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(os.path.join(ROOT, "tessera")):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(base, f)
                    z.write(path, os.path.relpath(path, ROOT))
    print(out)


if __name__ == "__main__":
    main()
