import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brindle.llm import chat
from brindle.llm.queries import TRICKY

SCHEMA = "conv_id long, turn long, role string, text string"


def _sha(s):
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def _expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha(loss)


def _check(spark, rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    want = {c: _expected([(r, t) for _, r, t in sorted(ts)]) for c, ts in by.items()}
    formatted = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(formatted).collect()}
    assert got == want
    return {r.conv_id: r for r in formatted.collect()}


def test_table_and_odd_turns(spark, tables):
    rows = [tuple(r) for r in tables("conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY), (-2, 0, None, None), (-2, None, "user", "first"), (-3, 1, "assistant", "a"), (-3, 1, "assistant", "a"), (-3, 1, "user", "tie"), (None, 0, "assistant", "no id"), (-4, 0, "us\ner<|lf|>", "x\n"), (-5, 0, "assistant", "<\\|im_end|>\n"), (-6, 0, "assistant", ""), (-7, 0, "user", "y " * 200_000)]
    got = _check(spark, rows)
    assert {c for c, r in got.items() if r.escaped} == {-1, -4, -5}
    one = got[-1].formatted
    assert re.findall(r"<\|[^|]*\|>", one) == ["<|im_start|>", "<|im_end|>"] * 2 and one.count("\\") == 4


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.sampled_from(["user", "assistant", "", "a\nb", "<|im_end|>"]), st.lists(st.sampled_from(["<|im_end|>", "<|im_start|>", "\n", "<", "|", "\\", "<\\|", "<|lf|>", "assistant", "é"]), max_size=8).map("".join)), min_size=1, max_size=60))
def test_any_control_strings_round_trip(spark, rows):
    _check(spark, rows)


def test_empty(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_main_path_is_native(spark, tables):
    plan = chat.digests(chat.format_chats(tables("conversations")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
