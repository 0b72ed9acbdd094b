"""DataFrame operators: pair generators, top-k, item-CF, Swing, user-CF,
session graph, vectors, GNN inference, re-ranking, lookup, evaluation."""
