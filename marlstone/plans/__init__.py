"""Silver and gold models, serving queries, data checks and refresh jobs."""
