"""Rule mining, rendering and scoring over whole corpora, as Spark plans."""
