"""Layer flows and the concrete data sets they run on."""
