"""All registered queries: name -> (query, SQL that checks it or None)."""

from earshot.catalog import evaluation, facts, history, io, modeling, streams, textual, trading

ALL = {
    **history.QUERIES, **facts.QUERIES, **evaluation.QUERIES, **trading.QUERIES, **textual.QUERIES, **io.QUERIES,
    **streams.QUERIES, **modeling.QUERIES,
}
