"""Complete jobs made of the operators: featurizers, learners, the run from notes to metrics."""
