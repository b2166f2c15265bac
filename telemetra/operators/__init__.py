"""DataFrame operators: decode/validate/route, event time and lateness,
windowed aggregation with late re-firing, point projections and detectors."""
