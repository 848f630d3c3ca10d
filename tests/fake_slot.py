"""A database driver for tests that keeps the rules of a server's slots.

The log is a JSON file named by the connection string: entries ``[position, transaction,
bytes in hex]`` in order of their positions, where null bytes stand for a commit. A peek
gives committed transactions in the order of their commits, whole, each between a Begin
and a Commit row; up to a position means transactions that commit up to it, and a number of
rows is only checked after a whole transaction. A slot begins where it was moved to.
"""

import json
from pathlib import Path


def position(text):
    high, low = text.split("/")
    return int(high, 16) << 32 | int(low, 16)


def text(number):
    return f"{number >> 32:X}/{number & 0xFFFFFFFF:X}"


def peek(state, slot, upto, most):
    rows, changes = [], {}
    for at, xid, data in state["log"]:
        if data is not None:
            changes.setdefault(xid, []).append((at, bytes.fromhex(data)))
            continue
        done = changes.pop(xid, [])
        if position(at) > position(state["slots"][slot]) and (upto is None or position(at) <= position(upto)):
            rows.append((done[0][0] if done else at, b"B" + position(at).to_bytes(8, "big") + bytes(12)))
            rows += done
            rows.append((at, b"C" + bytes(25)))
            if most is not None and len(rows) >= most:
                break
    return [(n, lsn, data) for n, (lsn, data) in enumerate(rows, 1)]


class Cursor:
    def __init__(self, path):
        self.path, self.rows = path, []

    def execute(self, sql, values):
        state = json.loads(self.path.read_text())
        if "EXISTS" in sql:
            self.rows = [(values[0] in state["slots"],)]
        elif "pg_create" in sql:
            state["slots"][values[0]] = state.get("created", "0/0")
            self.rows = [(values[0],)]
        elif "current_wal" in sql:
            self.rows = [(state["log"][-1][0] if state["log"] else "0/0",)]
        elif "advance" in sql:
            to, slot, _ = values
            if position(state["slots"][slot]) < position(to):
                state["slots"][slot] = to
                self.rows = [(to,)]
        elif sql.startswith("SELECT n, lsn"):
            slot, upto, most, _ = values
            self.rows = [(n, lsn, data[0]) for n, lsn, data in peek(state, slot, upto, most) if data[:1] in b"BC"]
        else:
            slot, upto, most, _, after, to = values
            self.rows = [(n, data) for n, _, data in peek(state, slot, upto, most) if after < n <= to and data[:1] not in (b"B", b"C")]
        state["fetched"] = max(state.get("fetched", 0), len(self.rows) if "n, data" in sql else 0)
        self.path.write_text(json.dumps(state))

    def fetchmany(self, n):
        page, self.rows = self.rows[:n], self.rows[n:]
        return page


class Connection:
    def __init__(self, path):
        self.path = Path(path)

    def cursor(self):
        return Cursor(self.path)

    def commit(self):
        pass

    def close(self):
        pass


def connect(dsn):
    return Connection(dsn)
