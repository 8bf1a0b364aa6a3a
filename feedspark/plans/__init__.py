"""Feed specifications, load pipelines, the feed job and derived landing areas."""
