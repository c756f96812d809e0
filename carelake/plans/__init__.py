"""Plan-shaping helpers: session settings, materialisation, distributed numbering."""
