"""footfall: batch session and category reports over shop clickstream tables."""
