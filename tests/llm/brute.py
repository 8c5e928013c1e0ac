"""Plain reference versions on small inputs."""

from __future__ import annotations

import hashlib
import re

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    out.sort()
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in out)
    return [sum(k == j for _, k, _ in out) for j in range(3)] + [hashlib.sha256(joined.encode()).hexdigest()]


def pii_base(text):
    text = text or ""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    out.sort()
    joined = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for k, s, e in out)
    return [sum(k == j for k, _, _ in out) for j in range(4)] + [hashlib.sha256(joined.encode()).hexdigest()]
