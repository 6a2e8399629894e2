"""DataFrame operators: cleaning, activity, labelling, graph measures, scaling."""
