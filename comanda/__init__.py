"""comanda: order analytics (star schema, cubes, marts, order graph, dispatch) as Spark DataFrame jobs."""
