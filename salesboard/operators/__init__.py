"""DataFrame operators: parse, measures, state, ranking, serving, series, tree, panels."""
