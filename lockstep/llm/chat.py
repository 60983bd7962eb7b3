"""Chat formatting as prefix trees: conversations that share initial turns share their tokens.

A conversation's path is the chain of its turns' digests. Distinct paths are dealt by range and
sorted, which is a depth-first order of the tree of all conversations: a common
prefix of paths is a common prefix of turns. Each task walks its range and emits a node's tokens once, with position ids that
continue the parent's, and for every node the token intervals of its ancestors, to which (besides
itself, causally) its tokens attend. A pack holds about ``pack`` tokens and is complete in itself: where a subtree goes
on in another pack, that pack repeats the ancestors. So a first turn that very many
conversations share is spread over packs and tasks, never gathered in one.

Template: ``<turn ROLE>\\n`` TEXT ``</turn>\\n``. In roles and texts ``\\`` becomes ``\\\\``,
``<`` ``\\l``, ``>`` ``\\g``; in roles a line break becomes ``\\n``. So markers occur in no text, and
reading is exact. Tokens are code points. The loss mask covers the assistants' texts.

Shuffles: turns by conversation, conversations by path, paths by range, and an equi-join
of conversations to their path's result (copies of one conversation are a skewed key there, which is split).

Nulls: a null text or role is empty, a null turn comes first, rows with a null conv_id are one
conversation. Rows with equal turns are ordered by role and text; repeated rows
are repeated turns. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

ESCAPES = (("\\", "\\\\"), ("<", "\\l"), (">", "\\g"))
PLAIN = {"\\\\": "\\", "\\l": "<", "\\g": ">", "\\n": "\n"}
TURN = re.compile(r"<turn ([^>\n]*)>\n([^<]*)</turn>\n")
INTERVAL = "struct<start:int,end:int>"
_I32 = pa.int32()
_SPANS = pa.list_(pa.struct([("start", _I32), ("end", _I32)]))
ARROW = pa.schema([("tokens", pa.list_(_I32)), ("position_ids", pa.list_(_I32)), ("nodes", pa.list_(pa.struct([("start", _I32), ("end", _I32), ("position", _I32), ("parent", _I32), ("ancestors", _SPANS)]))), ("loss", _SPANS), ("leaves", pa.list_(pa.struct([("path", pa.string()), ("node", _I32)])))])
PACKS = f"tokens array<int>, position_ids array<int>, nodes array<struct<start:int,end:int,position:int,parent:int,ancestors:array<{INTERVAL}>>>, loss array<{INTERVAL}>, leaves array<struct<path:string,node:int>>"
DIGEST = 24


def escape(text: str) -> str:
    for a, b in ESCAPES:
        text = text.replace(a, b)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lgn]", lambda m: PLAIN[m.group()], text)


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, path and turns of every conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    digest = F.transform("turns", lambda t: F.substring(F.sha2(F.concat(F.length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"]), 256), 1, DIGEST))
    return convs.select("conv_id", F.array_join(digest, "").alias("address"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")).withColumn("path", F.sha2("address", 256))


def packs_of(paths: Iterator[tuple[str, str, list[dict]]], pack: int, assistant: str) -> Iterator[dict]:
    """Packs from (address, path, turns) in order of addresses."""
    stack: list[tuple[str, int]] = []  # digest and node of the open branch
    text: list[str] = []
    size, out = 0, {"nodes": [], "loss": [], "leaves": []}

    def close():
        tokens = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.int32)
        places = np.concatenate([np.arange(n["position"], n["position"] + n["end"] - n["start"], dtype=np.int32) for n in out["nodes"]])
        return {"tokens": tokens, "position_ids": places} | out

    for address, path, turns in paths:
        if size > pack and out["leaves"]:
            yield close()
            stack, text, size, out = [], [], 0, {"nodes": [], "loss": [], "leaves": []}
        digests = [address[i : i + DIGEST] for i in range(0, len(address), DIGEST)]
        same = 0
        while same < min(len(stack), len(digests)) and stack[same][0] == digests[same]:
            same += 1
        del stack[same:]
        for digest, t in zip(digests[same:], turns[same:]):
            head = f"<turn {escape(t['role']).replace(chr(10), chr(92) + 'n')}>\n"
            body = escape(t["text"])
            parent = stack[-1][1] if stack else -1
            above = out["nodes"][parent] if stack else None
            start, end = size, size + len(head) + len(body) + 8
            out["nodes"].append({"start": start, "end": end, "parent": parent, "position": above["position"] + above["end"] - above["start"] if above else 0, "ancestors": [*above["ancestors"], {"start": above["start"], "end": above["end"]}] if above else []})
            if t["role"] == assistant:
                out["loss"].append({"start": start + len(head), "end": end - 8})
            text += [head, body, "</turn>\n"]
            size = end
            stack.append((digest, len(out["nodes"]) - 1))
        out["leaves"].append({"path": path, "node": stack[-1][1]})
    if out["leaves"]:
        yield close()


def format_trees(convs: DataFrame, pack: int = 1 << 16, assistant: str = "assistant") -> DataFrame:
    """Packs of tokens for the distinct paths of convs."""

    def walk(batches):
        rows = ((a, p, t) for b in batches for a, p, t in zip(b.column("address").to_pylist(), b.column("path").to_pylist(), b.column("turns").to_pylist()))
        for x in packs_of(rows, pack, assistant):
            yield pa.record_batch([pa.array([x[f.name]], f.type) for f in ARROW], schema=ARROW)

    distinct = convs.select("address", "path", "turns").dropDuplicates(["path"])
    return distinct.repartitionByRange("address").sortWithinPartitions("address").mapInArrow(walk, PACKS)


def read_back(packs: DataFrame) -> DataFrame:
    """What each path's tokens say: number of turns, digests and lengths."""

    def read(batches):
        for b in batches:
            rows = []
            tokens_of = b.column("tokens")
            for k, x in enumerate(b.drop_columns(["tokens", "position_ids"]).to_pylist()):
                tokens = np.asarray(tokens_of[k].values)
                mask = np.zeros(len(tokens), bool)
                for i in x["loss"]:
                    mask[i["start"] : i["end"]] = True
                for leaf in x["leaves"]:
                    node = x["nodes"][leaf["node"]]
                    spans = [*node["ancestors"], node]
                    text = np.concatenate([tokens[s["start"] : s["end"]] for s in spans]).tobytes().decode("utf-32-le", "surrogatepass")
                    under = np.concatenate([np.where(mask[s["start"] : s["end"]], tokens[s["start"] : s["end"]], -1) for s in spans])
                    learned = unescape(under[under >= 0].astype(np.int32).tobytes().decode("utf-32-le", "surrogatepass"))
                    turns = [(unescape(r), unescape(t)) for r, t in TURN.findall(text)]
                    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((leaf["path"], len(turns), digest, len(learned), hashlib.sha256(learned.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return packs.mapInArrow(read, "path string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digests(rows: DataFrame) -> DataFrame:
    """conv_id and what its formatted form says, for each conversation."""
    convs = conversations(rows)
    told = cut(read_back(format_trees(convs)))  # so that the join can split a path with very many conversations
    return convs.select("conv_id", "path").join(told, "path").drop("path")
