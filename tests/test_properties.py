"""Properties that hold for any input."""

from hypothesis import HealthCheck, given, settings, strategies as st

from loglode.model import FULL_COLUMNS, MAIN_FORMAT
from loglode.operators.counters import counter_columns
from loglode.operators.parse import compile_format, parse_text
from loglode.operators.rules import Rule
from loglode.plans.pipeline import Ingest

FIELDS, _ = compile_format(MAIN_FORMAT)
QUICK = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))

# What may stand in each field: anything but the character that ends it.
ANY = st.characters(codec="utf-8", exclude_characters="\n\r\x00")


def field(stop: str):
    return st.text(ANY.filter(lambda c: c not in stop), max_size=12)


ENTRY = st.fixed_dictionaries(
    {
        "remote_addr": field(" "), "remote_user": field(" "), "time_local": field("]"),
        "request": field('"'), "status": field(" "), "bytes_sent": field(" "),
        "http_referer": field('"'), "http_user_agent": field('"'),
    }
)


def render(entry: dict) -> str:
    line = MAIN_FORMAT
    for name in sorted(entry, key=len, reverse=True):
        line = line.replace("$" + name, "\ue000" + name + "\ue001")
    for name, text in entry.items():
        line = line.replace("\ue000" + name + "\ue001", text.replace("\ue000", "").replace("\ue001", ""))
    return line


@QUICK
@given(entries=st.lists(ENTRY, min_size=20, max_size=60))
def test_parsing_undoes_rendering(spark, lines, entries):
    entries = [
        {k: v.replace("\ue000", "").replace("\ue001", "") for k, v in e.items()} for e in entries
    ]
    rows = parse_text(lines(*[render(e) for e in entries]), MAIN_FORMAT).orderBy("id").collect()
    assert [{name: row[name] for name in FIELDS} for row in rows] == entries


@QUICK
@given(texts=st.lists(st.one_of(st.text(ANY), ENTRY.map(render)), min_size=20, max_size=60))
def test_any_line_is_accounted_for(spark, lines, texts):
    source = lines(*texts)
    rules = (Rule("status >= 100 or contains(request, 'a')", "drop"),)
    for log_format in (MAIN_FORMAT, None):
        job = Ingest(log_format, FULL_COLUMNS, rules)
        judged = job.judged(source)
        counted = judged.agg(*counter_columns()).first()
        assert counted.lines_read == len(texts)
        assert counted.lines_read == counted.parse_errors + counted.lines_filtered + counted.lines_processed
        assert job.rows(judged).count() == counted.lines_processed
